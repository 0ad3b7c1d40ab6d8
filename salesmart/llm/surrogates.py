"""PII: keyed, type-consistent surrogates for detected entities.

Detected: e-mail addresses, phone numbers, IPv4 addresses, payment card
numbers, social security numbers, hexadecimal secrets, and person names (a
title or a known given name, see ``given_names``, before a capitalised surname).  Each entity has a
canonical form; its surrogate is drawn from HMAC-SHA256 of a secret key, the
type, the canonical form and an attempt number.  So one entity gets the same
surrogate in every document (coreference), in the format it was written in:
punctuation, digit groups, letter case, the Luhn property of a card, private
address ranges, and for names the script and the gender of the given name.

Two entities of a type must not share a surrogate, and no surrogate may be an
entity of the corpus.  Both are checked over the whole corpus with joins on
(type, surrogate); the later entity of a clash draws again with the next
attempt, in rounds, until nothing clashes.  The space drawn from grows with the
attempt (a syllable, a letter, a digit, a wider address range), so crowded
types come to an end too; formats that cannot grow (social security numbers,
cards, secrets, all of IPv4) raise after ``MAX_ROUNDS``.  Only entities past
attempt 0, a small table, have to be looked up when texts are rewritten.
"""

from __future__ import annotations

import hashlib
import hmac
import re

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import own_columns, text_part, with_few, written
from .given_names import KNOWN

#: Given names of surrogates by script and gender (names are detected by these and ``KNOWN``); surnames by script.
GIVEN = {
    ("latin", "f"): ["Alice", "Anna", "Clara", "Elena", "Emma", "Julia", "Laura", "Lucia", "Maria", "Marie", "Nora", "Olivia", "Paula",
                     "Rosa", "Sarah", "Sofia"],
    ("latin", "m"): ["Adam", "Carlos", "Daniel", "David", "Felix", "Hugo", "Jan", "John", "Lucas", "Luis", "Martin", "Oscar", "Paul",
                     "Peter", "Simon", "Thomas"],
    ("cyrillic", "f"): ["Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Ольга", "София"],
    ("cyrillic", "m"): ["Андрей", "Борис", "Виктор", "Иван", "Максим", "Олег", "Павел", "Сергей"],
    ("greek", "f"): ["Άννα", "Ελένη", "Ειρήνη", "Κατερίνα", "Μαρία", "Σοφία"],
    ("greek", "m"): ["Αλέξανδρος", "Γιώργος", "Δημήτρης", "Κώστας", "Νίκος", "Πέτρος"],
}
SYLLABLES = {"latin": ["bar", "den", "fal", "gor", "hen", "kel", "lin", "mar", "nor", "ros", "sel", "tor", "ver", "wil"],
             "cyrillic": ["бар", "вер", "гор", "дем", "зар", "кол", "лев", "мир", "нов", "рос", "сел", "тар"],
             "greek": ["βαρ", "γερ", "δαν", "καλ", "λαμ", "μαρ", "νικ", "παπ", "ρος", "στα", "τελ", "χρι"]}
TITLES = {"mr": "m", "mrs": "f", "ms": "f", "miss": "f", "herr": "m", "frau": "f", "señor": "m", "señora": "f", "mme": "f", "dr": ""}

#: Gender of a given name; names of both genders have none.
_GIVEN_GENDER: dict[str, str] = {}
for (_, _g), _names in [*KNOWN.items(), *GIVEN.items()]:
    for _n in _names:
        _GIVEN_GENDER[_n.lower()] = _g if _GIVEN_GENDER.get(_n.lower(), _g) == _g else ""
_ALL_GIVEN = sorted({n for lists in (KNOWN, GIVEN) for names in lists.values() for n in names})
#: One branch a first letter, so that a word is compared with few names.
_NAME = "|".join(f"{c}(?:{'|'.join(n[1:] for n in _ALL_GIVEN if n[0] == c)})" for c in sorted({n[0] for n in _ALL_GIVEN}))
_CAP = r"[A-ZÀ-ÖØ-ÞΆ-ΏΑ-ΩА-ЯЁ][^\W\d_]+"
#: Types in order of precedence; a later type does not match inside an earlier one's span.
PATTERNS = [
    ("email", re.compile(r"(?<![\w.+-])[A-Za-z0-9][\w.+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![\w-])")),
    ("secret", re.compile(r"(?<![0-9A-Za-z])(?=[0-9A-Fa-f]*[0-9])(?=[0-9A-Fa-f]*[A-Fa-f])[0-9A-Fa-f]{32,64}(?![0-9A-Za-z])")),
    ("ip", re.compile(r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)")),
    ("card", re.compile(r"(?<!\d)(?:\d{4}[ -]){3}\d{4}(?!\d)|(?<!\d)\d{13,19}(?!\d)")),
    ("ssn", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])")),
    ("phone", re.compile(r"(?<![\w+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\w])\(\d{3}\) ?\d{3}-\d{4}(?!\d)"
                         r"|(?<![\d-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])")),
    ("name", re.compile(rf"\b(?:(?:Mr|Mrs|Ms|Miss|Dr|Herr|Frau|Señora|Señor|Mme)\.?[ ]{_CAP}(?:[ ]{_CAP})?|(?:{_NAME})[ ]{_CAP})")),
]
_DIGIT = re.compile(r"\d")
#: Every number pattern consists of these characters and has at least seven: the stretches it can match in.
_STRETCH = re.compile(r"[+(\d][\d .()+-]{6,}")
_NUMBERS = ("ip", "card", "ssn", "phone")
#: Titles and given names, to see in one pass whether the name pattern can match at all.
_NAMES = ahocorasick.Automaton()
for _n in [*_ALL_GIVEN, "Mr", "Mrs", "Ms", "Miss", "Dr", "Herr", "Frau", "Señor", "Señora", "Mme"]:
    _NAMES.add_word(_n + " ", True)
    _NAMES.add_word(_n + ". ", True)
_NAMES.make_automaton()
ENTITIES = "array<struct<kind:string,canonical:string>>"
#: Fixed-format types give up after this many rounds: more than about three quarters of their values are taken.
MAX_ROUNDS = 64
#: Attempts that stay within a phone number's length, or within the private address ranges.
SAME_LENGTH, SAME_RANGE = 4, 16


def _name_parts(surface: str) -> tuple[str, str, str, str]:
    """(title with its space, gender from it, given name or '', surname)."""
    title = re.match(r"(\w+)\.? ", surface)
    lead = title.group(0) if title and title.group(1).lower() in TITLES else ""
    rest = surface[len(lead):].split(" ")
    gender = TITLES.get(lead.rstrip(". ").lower(), "")
    return lead, gender, (rest[0] if len(rest) > 1 else ""), rest[-1]


def canonical(kind: str, surface: str) -> str:
    """What makes two mentions the same entity: digits of numbers, lower case of the others, names without their title."""
    if kind in ("phone", "card", "ssn"):
        return re.sub(r"\D", "", surface)
    if kind == "ip":
        return ".".join(str(int(x)) for x in surface.split("."))
    if kind == "name":
        _, gender, given, last = _name_parts(surface)
        return f"{given} {last}".strip().lower() if given else f"{gender} {last}".lower()
    return surface.lower()


def detect(text: str | None) -> list[tuple[str, str, int, int]]:
    """(kind, surface, first character, past the last) of every entity, in text order, without overlaps."""
    text = text or ""
    # each pattern needs an "@", a digit or a name; most texts have none of them
    wanted = {"email": "@" in text, "name": next(_NAMES.iter(text), None) is not None}
    digits = _DIGIT.search(text) is not None
    if not digits and not any(wanted.values()):
        return []
    found: list[tuple[str, str, int, int]] = []
    taken = bytearray(len(text))
    stretches = [m.span() for m in _STRETCH.finditer(text)] if digits else []
    for kind, pattern in PATTERNS:
        if not wanted.get(kind, digits):
            continue
        places = stretches if kind in _NUMBERS else [(0, len(text))]
        for m in (m for a, b in places for m in pattern.finditer(text, a, b)):
            a, b = m.span()
            if not any(taken[a:b]):
                taken[a:b] = b"\1" * (b - a)
                found.append((kind, m.group(), a, b))
    return sorted(found, key=lambda x: x[2])


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


class _Draw:
    """Numbers from a keyed stream."""

    def __init__(self, key: bytes, *parts: object):
        self.key, self.seed, self.n, self.pool = key, "\x1f".join(map(str, parts)).encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 8:
            self.pool += hmac.new(self.key, self.seed + self.n.to_bytes(4, "big"), hashlib.sha256).digest()
            self.n += 1
        x, self.pool = int.from_bytes(self.pool[:8], "big"), self.pool[8:]
        return x % n


def _script(word: str) -> str:
    return "cyrillic" if re.match("[А-яЁё]", word) else "greek" if re.match("[Ά-ώ]", word) else "latin"


def surrogate(kind: str, canon: str, attempt: int, key: bytes) -> str:
    """The canonical form of the replacement; later attempts draw from larger spaces."""
    d = _Draw(key, kind, canon, attempt)
    digit = lambda: str(d.below(10))
    if kind == "email":
        local, _, domain = canon.partition("@")
        labels = domain.split(".")
        swap = lambda s: "".join(digit() if c.isdigit() else "abcdefghijklmnopqrstuvwxyz"[d.below(26)] if c.isalpha() else c for c in s)
        more = "".join("abcdefghijklmnopqrstuvwxyz"[d.below(26)] for _ in range(attempt))
        return swap(local) + more + "@" + ".".join([*map(swap, labels[:-1]), labels[-1]])
    if kind == "secret":
        return "".join("0123456789abcdef"[d.below(16)] for _ in canon)
    if kind == "ip":
        o = canon.split(".")
        keep = 1 if o[0] == "10" else 2 if o[:2] == ["192", "168"] or (o[0] == "172" and 16 <= int(o[1]) < 32) else 0
        first = [n for n in range(11, 224) if n not in (127, 172, 192)]
        if keep and attempt:
            # the largest private range, then any address
            o, keep = (["10"], 1) if attempt < SAME_RANGE else ([], 0)
        return ".".join(o[:keep] + [str(first[d.below(len(first))]) if keep == 0 and i == 0 else str(1 + d.below(254)) for i in range(4 - keep)])
    if kind == "card":
        body = "".join(digit() for _ in canon[:-1])
        luhn = next(x for x in "0123456789" if _luhn(body + x))
        return body + (luhn if _luhn(canon) else str((int(luhn) + 1 + d.below(9)) % 10))
    if kind == "name":
        given, _, last = canon.rpartition(" ")
        script = _script(last)
        either = "mf"[d.below(2)] if given not in ("m", "f", "") else given
        gender = _GIVEN_GENDER.get(given) or either
        syll = SYLLABLES[script]
        surname = "".join(syll[d.below(len(syll))] for _ in range(3 + attempt))
        if given in ("m", "f", ""):
            return f"{given} {surname}"
        names = GIVEN[(script, gender)]
        return f"{names[d.below(len(names))].lower()} {surname}"
    if kind == "phone":
        # the country code stays: of one to three digits in front, those beyond a ten-digit number
        keep = max(0, min(3, len(canon) - 10))
        return canon[:keep] + str(2 + d.below(8)) + "".join(digit() for _ in canon[keep + 1:]) + "".join(digit() for _ in range(attempt // SAME_LENGTH))
    return "".join(digit() for _ in canon)


def render(kind: str, surface: str, new: str) -> str:
    """``new`` (canonical) in the format of ``surface``: digit groups, letter case, title."""
    if kind in ("phone", "card", "ssn"):
        digits = iter(new)
        return "".join(next(digits) if c.isdigit() else c for c in surface) + "".join(digits)
    if kind == "name":
        lead, _, given, _ = _name_parts(surface)
        first, _, last = new.rpartition(" ")
        upper = surface[len(lead):].isupper()
        parts = [x.upper() if upper else x.title() for x in ([first, last] if given else [last])]
        return lead + " ".join(parts)
    return new.upper() if surface.isupper() and kind != "ip" else new


def replace(text: str | None, attempts: dict[tuple[str, str], int], key: bytes) -> tuple[str | None, list[tuple[str, str]]]:
    """The text with every entity replaced, and (kind, canonical form) of the mentions."""
    found = detect(text)
    if not found:
        return text, []
    out, at, seen = [], 0, []
    for kind, surface, a, b in found:
        canon = canonical(kind, surface)
        seen.append((kind, canon))
        out += [text[at:a], render(kind, surface, surrogate(kind, canon, attempts.get((kind, canon), 0), key))]
        at = b
    return "".join([*out, text[at:]]), seen


def entities_column(text: Column) -> Column:
    """Distinct (kind, canonical) of a text."""
    @F.pandas_udf(ENTITIES)
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"kind": k, "canonical": c} for k, c in sorted({(k, canonical(k, s)) for k, s, *_ in detect(t)})]
                          for t in texts], dtype=object)
    return of(text)


def _drawn(kind: Column, canon: Column, attempt: Column, key: bytes) -> Column:
    @F.pandas_udf("string")
    def of(k: pd.Series, c: pd.Series, a: pd.Series) -> pd.Series:
        return pd.Series([surrogate(*x, key) for x in zip(k, c, a)], dtype=object)
    return of(kind, canon, attempt)


def resolve(entities: DataFrame, key: bytes) -> DataFrame:
    """kind, canonical, attempt, surrogate of every distinct entity (kind, canonical): surrogates distinct by kind and no entity.

    Of entities that drew the same surrogate the first by canonical form keeps
    it; the others, and any that drew an entity of the corpus, draw again.
    Raises ValueError if a format that cannot grow holds too few values.
    """
    drawn = lambda df: df.withColumn("surrogate", _drawn(F.col("kind"), F.col("canonical"), F.col("attempt"), key))
    table = written(drawn(entities.select("kind", "canonical").distinct().withColumn("attempt", F.lit(0))), "surrogates")
    own = table.select("kind", F.col("canonical").alias("surrogate"))
    for _ in range(MAX_ROUNDS):
        # an earlier round's surrogate stays: the lowest (attempt, canonical) of a clash keeps it
        first = table.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "canonical")).alias("first"), F.count(F.lit(1)).alias("n"))
        clash = (table.join(first.where("n > 1"), ["kind", "surrogate"])
                 .where(F.struct("attempt", "canonical") != F.col("first")).select("kind", "canonical")
                 .unionByName(table.join(own, ["kind", "surrogate"], "left_semi").select("kind", "canonical")).distinct())
        clash = written(clash, "surrogate_clashes")
        if clash.isEmpty():
            return table
        again = drawn(table.join(clash, ["kind", "canonical"], "left_semi").withColumn("attempt", F.col("attempt") + 1))
        table = written(table.join(clash, ["kind", "canonical"], "left_anti").unionByName(again.select(*table.columns)), "surrogates")
    kinds = sorted(r["kind"] for r in clash.select("kind").distinct().collect())
    raise ValueError(f"too few surrogates of the format of {', '.join(kinds)}: still clashing after {MAX_ROUNDS} rounds")


@own_columns("text_col")
def pseudonymise(docs: DataFrame, key: bytes, text_col: str = "text", name: str = "entities") -> DataFrame:
    """``docs`` with entities of ``text_col`` replaced, plus the array ``name`` of (kind, canonical) mentions.

    * Whole texts are read; null stays null, texts without entities stay as they are.
    * Repeated rows stay and change alike.  A column called ``name`` is replaced.
    * An empty table, or one without entities, comes back unchanged but for ``name``.
    * Surrogates depend on the key and, for the rare clashes, on the entities of ``docs``.
    """
    text = F.col(text_col)
    named = (docs.where(text.isNotNull()).select(F.sha2(text_col, 256).alias("_d"), text_part(text).alias("_part"), entities_column(text).alias("e"))
             .where(F.size("e") > 0))
    named = written(named.select("_d", "_part", F.explode("e").alias("e")).select("_d", "_part", "e.kind", "e.canonical"), "entities")
    late = written(resolve(named, key).where("attempt > 0").select("kind", "canonical", "attempt"), "surrogates_late")
    # the attempts a text needs to know: for all but a few texts, none
    per_text = (named.join(late, ["kind", "canonical"]).distinct().groupBy("_d", "_part")
                .agg(F.collect_list(F.struct("kind", "canonical", "attempt")).alias("_late")))
    per_text = written(per_text, "entities_late")
    out = docs.drop(name)
    out = with_few(docs.drop(name), text_col, per_text, "_late")

    @F.pandas_udf(f"struct<text:string,entities:{ENTITIES}>")
    def rewritten(texts: pd.Series, lates: pd.Series) -> pd.DataFrame:
        rows = [replace(t, {(x["kind"], x["canonical"]): x["attempt"] for x in (late if late is not None else [])}, key)
                for t, late in zip(texts, lates)]
        return pd.DataFrame({"text": [r[0] for r in rows], "entities": [[{"kind": k, "canonical": c} for k, c in r[1]] for r in rows]})
    out = out.withColumn("_new", rewritten(text, F.col("_late")))
    return out.select(*[F.col("_new.text").alias(c) if c == text_col else F.col(c) for c in docs.columns if c != name],
                      F.col("_new.entities").alias(name))
