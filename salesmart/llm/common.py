"""Helpers shared by the training-data operators (native expressions and shared-folder tables)."""

from __future__ import annotations

import functools
import inspect
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path

#: White space of the word rules: space and the control characters 0x09-0x0D.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD_CLASS = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    Everything derived from the result sees the same rows, the work is done
    once, and a lost executor costs a re-read, not a recomputation.  Meant for
    narrow tables (ids, sizes, digests), never for texts.
    """
    path = work_path(df.sparkSession, f"{name}_{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def values(spark: SparkSession, schema: str, rows: list[tuple]) -> DataFrame:
    """A small literal table as a local relation, whose size Spark knows when it plans joins."""
    cols = [c.strip().split(" ") for c in schema.split(",")]
    casts = ", ".join(f"CAST(col{i + 1} AS {t}) AS `{n}`" for i, (n, t) in enumerate(cols))
    if not rows:
        return spark.sql("SELECT " + ", ".join(f"CAST(NULL AS {t}) AS `{n}`" for n, t in cols) + " WHERE false")
    w = len(cols)
    marks = ", ".join("(" + ", ".join(f":p{i * w + j}" for j in range(w)) + ")" for i in range(len(rows)))
    return spark.sql(f"SELECT {casts} FROM VALUES {marks}", args={f"p{i}": v for i, v in enumerate(v for r in rows for v in r)})


def spaced(text: Column) -> Column:
    """The text with every white-space character as one space ('' for null): plain byte replacements, no regex."""
    out = F.coalesce(text, F.lit(""))
    for c in "\t\n\x0b\x0c\r":
        out = F.replace(out, F.lit(c), F.lit(" "))
    return out


def words(text: Column) -> Column:
    """Array of the words of a text; empty for null."""
    return F.filter(F.split(spaced(text), " "), lambda w: w != "")


def n_words(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.size(words(text)).cast("long")


def let(value: Column, body) -> Column:
    """``body(v)`` with ``value`` evaluated once, however often ``v`` occurs in it."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """``df`` plus ``name``, computed exactly once a row.

    A one-element explode: unlike a projection, the optimiser neither pushes
    filters through it nor inlines the value into later expressions, where an
    expensive array would be built again for every use.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


#: Parts of the text hashes (at most 2^18 numbers are broadcast) and salts over which the rows of one text are dealt.
PART_BITS, SALTS = 18, 16


def text_part(text: Column) -> Column:
    """The part of the hash space that a text lies in; null for null."""
    return F.when(text.isNotNull(), F.shiftrightunsigned(F.xxhash64(text), 64 - PART_BITS))


def with_few(docs: DataFrame, text_col: str, few: DataFrame, name: str) -> DataFrame:
    """``docs`` plus the column ``name`` of ``few`` (_d: SHA-256 of a text, each once; _part: its ``text_part``; ``name``), null elsewhere.

    For a ``few`` that names few of the texts: those outside its parts, and null
    texts, stay where they are.  The others are shuffled by digest, equal texts
    dealt over salts by the partition they come from.
    """
    none = F.lit(None).cast(few.schema[name].dataType).alias(name)
    if few.isEmpty():
        return docs.select("*", none)
    parts, docs = F.broadcast(few.select("_part").distinct()), docs.withColumn("_part", text_part(F.col(text_col)))
    still = docs.join(parts, "_part", "left_anti").drop("_part").select("*", none)
    moved = docs.join(parts, "_part", "left_semi").drop("_part").withColumns({
        "_d": F.sha2(text_col, 256), "_salt": F.pmod(F.spark_partition_id(), F.lit(SALTS))})
    salted = few.select("_d", name, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    return still.unionByName(moved.join(salted, ["_d", "_salt"], "left").drop("_d", "_salt"))


def own_columns(*parameters: str):
    """For ``fn(docs, ...)``: the caller's columns go in under neutral names and come back under their own.

    Whatever they are called (helper names of ``fn``, names with dots, the same
    name twice), their values stay; ``parameters`` are the arguments of ``fn``
    that name one of them.  A column with the name of one that ``fn`` adds is replaced by it.
    """
    def deco(fn):
        signature = inspect.signature(fn)

        @functools.wraps(fn)
        def run(docs: DataFrame, *args, **kw) -> DataFrame:
            bound = signature.bind(docs, *args, **kw)
            bound.apply_defaults()
            back = {f"c{i}_": n for i, n in enumerate(docs.columns)}
            at = {n: c for c, n in reversed(back.items())}
            bound.arguments["docs"] = docs.toDF(*back)
            for p in parameters:
                if bound.arguments[p] not in at:
                    raise ValueError(f"no column {bound.arguments[p]!r}")
                bound.arguments[p] = at[bound.arguments[p]]
            out = fn(*bound.args, **bound.kwargs)
            added = {c for c in out.columns if c not in back}
            kept = [c for c in out.columns if c in added or back[c] not in added]
            return out.select(*kept).toDF(*[back.get(c, c) for c in kept])
        return run
    return deco
