"""Prefix trie of conversations by range minima over sorted common prefixes.

1. Every conversation becomes a sequence of turn digests; equal sequences
   collapse to one with a count before anything is ordered.
2. The distinct sequences are put in a global order (``global_row_number``) and
   cut into blocks of about the square root of their number.  Each knows the
   length of its common prefix with the one before it (LCP), in turns.
3. A prefix of depth d at position i is shared by the positions around i
   between which no LCP is below d.  Every candidate prefix searches the left
   and the right end of that interval on its own, by halving steps over sparse
   tables of range minima: one a block, and one over the minima of the blocks.
   No stack and no order of evaluation is involved.
4. What a node reports follows from its interval: counts and bytes are
   differences of running sums, the smallest member is a range minimum too.

A prefix whose interval leaves its block also spans the block's border.  A
border is spanned by no more prefixes than its LCP, and each is resolved once
(``borders``), however many positions of the block ask for it.  The driver
holds one line a block, so neither a block nor that summary outgrows the
square root of the input.  A conversation's turns (16-byte digests and
lengths, no texts) lie in one array; a conversation of a million turns is 20 MB.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.keys import global_row_number
from .common import written

#: Least number of sequences in a block.
BLOCK = 256
#: Ids joined into one piece before a digest is taken over the pieces in order.
PIECE = 4096
NO_ONE = np.iinfo(np.int64).max
#: Running sums over positions: sequences with copies, prefixes of the next one, bytes of all copies, bytes below the LCP, positions.
SUMS = ("n", "f", "w", "d", "p")


class Minima:
    """Sparse table: minima of all ranges whose size is a power of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [np.asarray(values, np.int64)]
        while (half := 1 << (len(self.levels) - 1)) * 2 <= len(values):
            low = self.levels[-1]
            self.levels.append(np.minimum(low[:-half], low[half:]))

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minimum over first..last; ``NO_ONE`` for empty ranges."""
        out = np.full(len(first), NO_ONE)
        size = last - first + 1
        for k, level in enumerate(self.levels):
            at = (size >> k) == 1
            out[at] = np.minimum(level[first[at]], level[last[at] - (1 << k) + 1])
        return out

    def right(self, start: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Largest e >= start for which no value in start+1..e is below depth."""
        pos, n = start.copy(), len(self.levels[0])
        for k in range(len(self.levels) - 1, -1, -1):
            fits = pos + (1 << k) < n
            fits[fits] = self.levels[k][pos[fits] + 1] >= depth[fits]
            pos[fits] += 1 << k
        return pos

    def left(self, start: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Smallest e <= start for which no value in e+1..start is below depth."""
        pos = start.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            fits = pos - (1 << k) >= 0
            fits[fits] = self.levels[k][pos[fits] - (1 << k) + 1] >= depth[fits]
            pos[fits] -= 1 << k
        return pos


def turn_sequences(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """(conv_id, seq): the turns of each conversation in order, each a 16-byte digest of role and text with the text's bytes."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.substring(F.sha2(F.concat_ws(":", F.octet_length(role).cast("string"), role, text), 256), 1, 32))
    rows = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv_id"),
        F.struct(F.col(turn_col).alias("t"), role.alias("r"), digest.alias("d"), F.octet_length(text).alias("b")).alias("x"))
    inorder = F.sort_array(F.collect_list("x"))
    return rows.groupBy("conv_id").agg(F.transform(inorder, lambda x: F.struct(x["d"].alias("d"), x["b"].alias("b"))).alias("seq"))


def rebuilt(seqs: DataFrame, group: int = 5, longest: int = 9) -> DataFrame:
    """(conv_id, seq) with the first h turns taken from conversation ``conv_id - conv_id % group``; h = CRC-32 of the decimal id % longest."""
    base = seqs.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.slice("seq", 1, longest - 1).alias("head"))
    own = seqs.select("conv_id", "seq", (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
                      (F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest).cast("int").alias("h"))
    none = F.array().cast(dict(seqs.dtypes)["seq"])
    head = F.slice(F.coalesce("head", none), F.lit(1), F.col("h"))
    rest = F.slice("seq", F.col("h") + 1, F.greatest(F.size("seq") - F.col("h"), F.lit(0)))
    return own.join(base, "base", "left").select("conv_id", F.concat(head, rest).alias("seq"))


def _sums(tops: dict, first: np.ndarray, last: np.ndarray, name: str) -> np.ndarray:
    return tops[name][last + 1] - tops[name][first]


def _common(a: Column, b: Column) -> Column:
    """Number of leading elements that a and b share; they differ somewhere."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    return (F.array_position(same, False) - 1).cast("int")


def trie(seqs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row a node of the trie over ``seqs`` (conv_id, seq array of (d, b)).

    conv_id (smallest member), depth, parent_conv_id (root: null), n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256 as the contract of
    ``conversation_trie`` says.  No sequences: no rows.  ``block``: least number of distinct sequences a block holds.
    """
    spark = seqs.sparkSession
    members = written(seqs.select("conv_id", "seq", F.sha2(F.concat_ws(",", F.transform("seq", lambda x: F.concat_ws(
        ":", F.hex(x["d"]), x["b"].cast("string")))), 256).alias("key")), "trie_members")
    kinds = members.groupBy("seq").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first"), F.min("key").alias("key"))
    ranked = written(global_row_number(kinds, ["seq"]), "trie_order")
    total = ranked.count()
    if not total:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
                                         "saved_tokens long, ends_sha256 string")
    rows = max(block, int(total ** 0.5))
    placed = ranked.withColumn("block", F.expr(f"(rn - 1) div {rows}"))
    # the last sequence of a block also opens the next one, to be compared with
    before = placed.where(F.col("rn") % rows == 0).withColumn("block", F.col("block") + 1).withColumn("real", F.lit(False))
    w = Window.partitionBy("block").orderBy("rn")
    prev = F.lag("seq").over(w)
    both = placed.withColumn("real", F.lit(True)).unionByName(before).withColumn("prev", prev).where("real")
    lengths = F.transform("seq", lambda x: x["b"])
    table = written(both.select(
        "rn", "block", "n", "first", "key", lengths.alias("bytes"),
        F.when(F.col("prev").isNull(), 0).otherwise(_common(F.col("seq"), F.col("prev"))).alias("lcp"),
        F.coalesce(F.size("prev"), F.lit(-1)).alias("prev_len")), "trie_lcp")

    summary = written(table.groupBy("block").applyInPandas(_summarise, _SUMMARY), "trie_blocks")
    tops = _tops(summary.select("block", "lcp_first", "least_lcp", "least_id", *SUMS).orderBy("block").toPandas())
    borders = written(_borders(summary, tops), "trie_borders")
    sides = borders.select(F.col("border").alias("block"), F.lit(True).alias("at_start"), *_SPAN).unionByName(
        borders.select((F.col("border") - 1).alias("block"), F.lit(False).alias("at_start"), *_SPAN))
    nodes = written(table.groupBy("block").cogroup(sides.groupBy("block")).applyInPandas(_nodes, _NODE), "trie_nodes")

    children = nodes.where("depth > 0").groupBy(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias("n_children"))
    # only nodes at which a sequence ends have a key: the others stay out of the join
    ended = nodes.where(F.col("key").isNotNull()).join(_ends(members, table), "key").select(*nodes.columns, "ends_sha256")
    inner = nodes.where(F.col("key").isNull()).withColumn("ends_sha256", F.lit(None).cast("string"))
    return (ended.unionByName(inner).join(children, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))


_SUMMARY = ("block long, lcp_first int, least_lcp int, least_id long, n long, f long, w long, d long, p long, "
            "heads array<struct<depth:int,least_id:bigint,n:bigint,f:bigint,w:bigint,d:bigint,p:bigint>>, "
            "tails array<struct<depth:int,least_id:bigint>>")
_SPAN = ["depth", "before_id", "after_id", *SUMS]
_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_leaves long, saved_tokens long, key string"


def _columns(rows: pd.DataFrame) -> dict[str, np.ndarray]:
    """Per position: lcp, length, ids and the summands of the running sums.

    f: the sequence before is a prefix of this one (so no leaf); w: bytes of
    all copies; d: bytes of the turns below the common prefix.
    """
    lcp, n = rows["lcp"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
    sums = [np.concatenate([[0], np.cumsum(np.asarray(b, np.int64))]) for b in rows["bytes"]]
    length = np.array([len(s) - 1 for s in sums])
    bytes_all = np.array([s[-1] for s in sums])
    return {"lcp": lcp, "len": length, "id": rows["first"].to_numpy(np.int64), "sums": sums, "n": n,
            "f": (rows["prev_len"].to_numpy(np.int64) == lcp).astype(np.int64), "w": n * bytes_all,
            "p": np.ones(len(n), np.int64), "d": bytes_all - np.array([s[c] for s, c in zip(sums, lcp)])}


def _summarise(rows: pd.DataFrame) -> pd.DataFrame:
    """One line a block; ``heads``/``tails``: what a prefix of each depth that comes in from the left/right covers of it."""
    rows = rows.sort_values("rn")
    c = _columns(rows)
    lcp, n = c["lcp"], len(rows)
    heads, tails = [], []
    least = np.minimum.accumulate(lcp)
    for depth in range(1, int(lcp[0]) + 1):
        stop = int(np.searchsorted(-least, -depth, side="right"))      # first position whose LCP is below depth
        if stop < n:
            heads.append({"depth": depth, "least_id": int(c["id"][:stop].min()), **{k: int(c[k][:stop].sum()) for k in SUMS}})
    least = np.minimum.accumulate(lcp[::-1])
    for depth in range(1, int(c["len"][-1]) + 1):
        stop = int(np.searchsorted(-least, -depth, side="right"))
        if stop < n:
            tails.append({"depth": depth, "least_id": int(c["id"][n - 1 - stop:].min())})
    return pd.DataFrame([{"block": int(rows["block"].iloc[0]), "lcp_first": int(lcp[0]), "least_lcp": int(lcp.min()),
                          "least_id": int(c["id"].min()), **{k: int(c[k].sum()) for k in SUMS}, "heads": heads, "tails": tails}])


def _tops(lines: pd.DataFrame) -> dict:
    """Sparse tables over the blocks, and running sums of the whole blocks."""
    out = {"lcp": Minima(lines["least_lcp"].to_numpy(np.int64)), "id": Minima(lines["least_id"].to_numpy(np.int64)), "size": len(lines)}
    return out | {k: np.concatenate([[0], np.cumsum(lines[k].to_numpy(np.int64))]) for k in SUMS}


def _borders(summary: DataFrame, tops: dict) -> DataFrame:
    """Every prefix that spans the start of a block: smallest id on either side, sums to the right."""
    size = tops["size"]

    @F.pandas_udf("struct<from_block:long,to_block:long,before_id:long,after_id:long,n:long,f:long,w:long,d:long,p:long>")
    def search(border: pd.Series, depth: pd.Series) -> pd.DataFrame:
        b, d = border.to_numpy(np.int64), depth.to_numpy(np.int64)
        # the blocks in which the prefix ends: beyond those that it covers as a whole
        whole = tops["lcp"].levels[0]
        to = np.where(whole[b] < d, b, tops["lcp"].right(b, d) + 1)
        start = np.where(d == 0, -1, tops["lcp"].left(b - 1, d))       # a depth of 0 ends nowhere
        first_whole, last_whole = start + 1, to - 1
        inside = np.minimum(last_whole, size - 1)
        return pd.DataFrame({
            "from_block": start, "to_block": to, "before_id": tops["id"].least(np.maximum(first_whole, 0), b - 1),
            "after_id": tops["id"].least(b, inside), **{k: _sums(tops, b, np.maximum(inside, b - 1), k) for k in SUMS}})

    spans = (summary.where("block > 0").select(F.col("block").alias("border"), F.explode(F.sequence(F.lit(0), "lcp_first")).alias("depth"))
             .withColumn("s", search("border", "depth")).select("border", "depth", "s.*"))
    heads = summary.select(F.col("block").alias("to_block"), F.explode("heads").alias("h")).select(
        "to_block", F.col("h.depth").alias("depth"), *[F.col(f"h.{k}").alias(f"h_{k}") for k in ("least_id", *SUMS)])
    tails = summary.select(F.col("block").alias("from_block"), F.explode("tails").alias("t")).select(
        "from_block", F.col("t.depth").alias("depth"), F.col("t.least_id").alias("t_least_id"))
    zero = F.lit(0).cast("long")
    return (spans.join(heads, ["to_block", "depth"], "left").join(tails, ["from_block", "depth"], "left").select(
        "border", "depth", F.least("before_id", F.coalesce("t_least_id", F.lit(int(NO_ONE)))).alias("before_id"),
        F.least("after_id", F.coalesce("h_least_id", F.lit(int(NO_ONE)))).alias("after_id"),
        *[(F.col(k) + F.coalesce(f"h_{k}", zero)).alias(k) for k in SUMS]))


def _nodes(rows: pd.DataFrame, sides: pd.DataFrame) -> pd.DataFrame:
    """Nodes that start in a block, with what their intervals hold."""
    if not len(rows):
        return pd.DataFrame({c.split(" ")[0]: [] for c in _NODE.split(", ")})
    rows = rows.sort_values("rn").reset_index(drop=True)
    c = _columns(rows)
    lcp, length, m = c["lcp"], c["len"], len(rows)
    # candidates: the prefix shared with the sequence before (the parent of what is new) and every longer one
    n_each = length - lcp + 1
    at = np.repeat(np.arange(m), n_each)
    depth = np.arange(len(at)) - np.repeat(np.cumsum(n_each) - n_each - lcp, n_each)
    table, ids = Minima(lcp), Minima(c["id"])
    left, right = table.left(at, depth), table.right(at, depth)

    def spanned(start: bool) -> tuple[pd.DataFrame, int]:
        part = sides[sides["at_start"] == start].sort_values("depth")
        return part, len(part) - 1                                     # depths 0 .. the border's LCP, none without a border
    opening, deepest_in = spanned(True)
    closing, deepest_out = spanned(False)
    goes_left, goes_right = (left == 0) & (depth <= deepest_in), (right == m - 1) & (depth <= deepest_out)
    least = ids.least(left, right)
    if goes_left.any():
        least[goes_left] = np.minimum(least[goes_left], opening["before_id"].to_numpy(np.int64)[depth[goes_left]])
    beyond = {k: np.zeros(len(at), np.int64) for k in SUMS}
    if goes_right.any():
        least[goes_right] = np.minimum(least[goes_right], closing["after_id"].to_numpy(np.int64)[depth[goes_right]])
        for k in SUMS:
            beyond[k][goes_right] = closing[k].to_numpy(np.int64)[depth[goes_right]]
    total = {k: np.concatenate([[0], np.cumsum(c[k])]) for k in SUMS}
    held = {k: total[k][right + 1] - total[k][left] + beyond[k] for k in SUMS}
    later = {k: total[k][right + 1] - total[k][at + 1] + beyond[k] for k in ("f", "d")}
    above = np.array([c["sums"][i][max(d - 1, 0)] for i, d in zip(at, depth)])
    whole = np.array([s[-1] for s in c["sums"]])[at]
    saved = held["w"] - held["n"] * above - (later["d"] + whole - above)
    is_root = (rows["rn"].to_numpy()[at] == 1) & (depth == 0)
    new = (depth > lcp[at]) | is_root
    parent = np.concatenate([[0], least[:-1]])
    has_parent = new & ~is_root
    return pd.DataFrame({
        "conv_id": least, "depth": depth, "parent_conv_id": pd.array(parent, "Int64"), "n_convs": held["n"],
        "n_leaves": held["p"] - later["f"], "saved_tokens": saved,
        "key": np.where(depth == length[at], rows["key"].to_numpy(object)[at], None)}).assign(
            parent_conv_id=lambda x: x["parent_conv_id"].where(has_parent))[new]


def _ends(members: DataFrame, table: DataFrame) -> DataFrame:
    """(key, ends_sha256): SHA-256 of the ids of equal sequences, ascending, comma-joined.

    A digest is serial: the ids of a sequence are sorted and joined in pieces
    by many tasks, and only the pieces pass through one, as a stream.
    """
    alone = table.where("n = 1").select("key", F.sha2(F.col("first").cast("string"), 256).alias("ends_sha256"))
    ids = members.join(table.where("n > 1").select("key"), "key").select("key", "conv_id")

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for key, part in rows.groupby("key", sort=False):
                x = part["conv_id"].to_numpy()
                for i in range(0, len(x), PIECE):
                    yield pd.DataFrame({"key": [key], "start": [x[i]], "ids": [",".join(map(str, x[i:i + PIECE].tolist()))]})

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, h = None, None
        for rows in batches:
            done = []
            for k, ids in zip(rows["key"], rows["ids"]):
                if k != key:
                    if h is not None:
                        done.append((key, h.hexdigest()))
                    key, h = k, hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
            yield pd.DataFrame(done, columns=["key", "ends_sha256"])
        if h is not None:
            yield pd.DataFrame([(key, h.hexdigest())], columns=["key", "ends_sha256"])

    joined = ids.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInPandas(pieces, "key string, start long, ids string")
    joined = written(joined, "trie_ends")
    shared = joined.repartition("key").sortWithinPartitions("key", "start").mapInPandas(digests, "key string, ends_sha256 string")
    return alone.unionByName(shared)


def conversation_trie(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                      block: int = BLOCK) -> DataFrame:
    """The trie of the rebuilt conversations of ``turns``, one row a node.

    * Turns are ordered by ``turn`` (null first); equal turn numbers by role, then by digest of role and text.
    * Null role or text is empty; a repeated row is a turn of its own.
    * Rows with a null id belong to no conversation.  An empty table gives no rows, not even a root.
    * Texts of any length count by digest and bytes; turns are equal if role and text are.
    * Only the four named columns enter, so no other name can clash.
    """
    return trie(rebuilt(turn_sequences(turns, id_col, turn_col, role_col, text_col)), block)
