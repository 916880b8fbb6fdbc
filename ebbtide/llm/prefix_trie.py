"""Trie of conversation prefixes, peeled from the deepest turn to the root.

A prefix is known by 128 bits, the exclusive or of one hash per turn and place: taking a turn away is another exclusive or, and
prefixes of a conversation of any length come from running sums in two levels. Equal conversations are merged first.

Peeling starts at the greatest depth. The nodes that survive from below meet the conversations that end here; the last turn is stripped and what
has become equal is merged, with its counts. A round strips a band of turns at once: survivors and newly ended conversations are laid out
along their turns within the band, equal prefixes are merged by one aggregate, which discovers the band's nodes, and what each adds to the nodes
above it in the band by another. Bands are tall where few conversations are that long. Rounds follow the longest conversation's length, not the number of rows.

Everything is sums and minima by prefix, combined before they are shuffled, and joins on single conversations: a first turn or a whole
conversation that a third of the rows share is one row per task. The digest of a node's members is the only sequential step: its ids come in
pieces of bounded size, sorted, and stream through one hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import staged

#: Rows that a band may lay out (rows in it times its height) before it gets less tall.
BAND_CELLS = 8_000_000
#: Turns of a band at least.
MIN_BAND = 8
#: Turns that are summed up inside one window.
BLOCK = 128
#: Rows of the ordered table whose conversations share a piece of a digest: so many ids at most.
PIECE = 2048
#: A conversation takes fewer turns than this from the first one of its five.
HEADS = 9
GROUP = 5

KEY = ["depth", "p1", "p2"]


def rebuilt(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(conversations: conv, length, piece; turns: conv, depth from 1, t1, t2, bytes, length) after the heads are exchanged.

    Conversation c starts with the first h turns of c - c % 5 and goes on with its own after its first h, h = crc32(c) % 9.
    Rows are ordered by turn, null first; equal turn numbers by a hash of role and text, which repeats. Null role or text
    is empty; rows without a conversation are left out.
    """
    body = [F.coalesce(F.col(c), F.lit("")) for c in (role, text)]
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("turn"), F.xxhash64(*body).alias("h1"), F.xxhash64(F.lit(1), *reversed(body)).alias("h2"),
        F.octet_length(body[1]).cast("long").alias("bytes"), F.monotonically_increasing_id().alias("tie"))
    order = ["conv", "turn", "h1", "h2", "tie"]
    # Row numbers over the whole order: a conversation may span tasks.
    lined = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "h1", "h2", "bytes", F.monotonically_increasing_id().alias("line")))
    part = F.shiftright("line", 33)
    runs = lined.groupBy("conv", part.alias("part")).agg(F.min("line").alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("conv")
    runs = staged(runs.select("conv", "part", "first", (F.sum("n").over(whole.orderBy("part")) - F.col("n")).alias("offset"), F.sum("n").over(whole).alias("own"), F.min("first").over(whole).alias("line")))
    one = runs.where("offset = 0").select("conv", "own", "line", (F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS).alias("h"), (F.col("conv") - F.col("conv") % GROUP).alias("donor"))
    donors = one.select(F.col("conv").alias("from"), F.col("own").alias("has"))
    one = one.join(donors, F.col("donor") == F.col("from"), "left").withColumn("taken", F.least("h", F.coalesce("has", F.lit(0))))
    one = staged(one.select("conv", "donor", "h", "taken", (F.col("taken") + F.greatest(F.lit(0), F.col("own") - F.col("h"))).alias("length"), F.expr(f"line div {PIECE}").alias("piece")))

    place = (F.col("offset") + F.col("line") - F.col("first")).alias("place")
    placed = staged(lined.withColumn("part", part).join(runs.drop("line", "own"), ["conv", "part"]).select("conv", place, "h1", "h2", "bytes"))
    own = placed.join(one, "conv").where("place >= h").select("conv", (F.col("taken") + F.col("place") - F.col("h") + 1).alias("depth"), "h1", "h2", "bytes", "length")
    heads = placed.where(F.col("place") < HEADS - 1).select(F.col("conv").alias("donor"), "place", "h1", "h2", "bytes")
    lent = one.join(heads, "donor").where("place < taken").select("conv", (F.col("place") + 1).alias("depth"), "h1", "h2", "bytes", "length")
    every = own.unionByName(lent).select("conv", "depth", F.xxhash64("depth", "h1").alias("t1"), F.xxhash64("h2", "depth").alias("t2"), "bytes", "length")
    return one.select("conv", "length", "piece"), every


def prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` plus p1, p2: the prefix that ends with the turn. Blocks are summed up first, then the turns inside a block."""
    rows = staged(turns.withColumn("block", F.expr(f"depth div {BLOCK}")))
    blocks = rows.groupBy("conv", "block").agg(F.bit_xor("t1").alias("x1"), F.bit_xor("t2").alias("x2"))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv", "block", *[F.coalesce(F.bit_xor(x).over(earlier), F.lit(0)).alias(x) for x in ("x1", "x2")])
    inside = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    got = rows.withColumns({"p1": F.bit_xor("t1").over(inside), "p2": F.bit_xor("t2").over(inside)}).join(blocks, ["conv", "block"])
    return got.select("conv", "depth", "t1", "t2", "bytes", "length", F.col("p1").bitwiseXOR(F.col("x1")).alias("p1"), F.col("p2").bitwiseXOR(F.col("x2")).alias("p2"))


def digests(members: DataFrame) -> DataFrame:
    """(depth, p1, p2, sha) of members (depth, p1, p2, conv, piece): SHA-256 of the ids in ascending order, joined by commas.

    A piece is a range of ids, with ``PIECE`` of them at most.
    """
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    pieces = members.groupBy(*KEY, "piece").agg(ids.alias("ids"))
    lined = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "piece").select(*KEY, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for *key, text in zip(*(c.to_pylist() for c in batch.columns)):
                if key != now:
                    if now is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = key, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield _rows(done)
        if now is not None:
            yield _rows([(*now, state.hexdigest())])

    return lined.mapInArrow(run, "depth long, p1 long, p2 long, sha string")


def _rows(done: Sequence[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, k in enumerate(kinds)], [*KEY, "sha"])


def bands(lengths: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """(above, down to) depths of the rounds, deepest first, from (length, how many distinct conversations have it).

    Heights double while the rows in the band times its height stay within ``BAND_CELLS``.
    """
    out, below = [], max((n for n, _ in lengths), default=0)
    while below > 0:
        height = MIN_BAND
        while height < below:
            above = max(0, below - 2 * height)
            rows = sum(many * (min(n, below) - above) for n, many in lengths if n > above)
            if rows * 2 * height > BAND_CELLS:
                break
            height *= 2
        out.append((max(0, below - height), below))
        below -= height
    return out


def _parent(c: str, t: str) -> Column:
    return F.col(c).bitwiseXOR(F.col(t)).alias(c)


def _peel(paths: DataFrame, ends: DataFrame, alive: DataFrame | None, above: int, below: int) -> DataFrame:
    """The nodes of the band (above, below]: depth, p1, p2, conv, n, kids, leaves, saved, q1, q2 (the parent's prefix).

    ``alive`` has what survived at depth ``below``: p1, p2, conv, n, kids, leaves, saved of the nodes beneath.
    """
    zero = F.lit(0).cast("long")
    ended = ends.where((F.col("depth") > above) & (F.col("depth") <= below)).select("conv", F.col("depth").alias("to"), "n", *[zero.alias(c) for c in ("kids", "leaves", "saved")])
    sources = ended if alive is None else ended.unionByName(alive.select("conv", F.lit(below).cast("long").alias("to"), "n", "kids", "leaves", "saved"))
    here = paths.where((F.col("depth") > above) & (F.col("depth") <= below)).drop("length")
    last = F.col("depth") == F.col("to")
    laid = here.join(sources, "conv").where(F.col("depth") <= F.col("to"))
    # Equal prefixes merge: this discovers the band's nodes.
    found = staged(laid.groupBy(*KEY).agg(
        F.min("conv").alias("conv"), F.sum("n").alias("n"), F.max("bytes").alias("bytes"), F.max("t1").alias("t1"), F.max("t2").alias("t2"), F.max(~last).alias("inner"),
        *[F.sum(F.when(last, F.col(c)).otherwise(0)).alias(c) for c in ("kids", "leaves", "saved")]))
    own = found.select("conv", F.col("depth").alias("to"), (F.col("leaves") + F.when(F.col("inner") | (F.col("kids") > 0), 0).otherwise(1)).alias("leaves"),
                       (F.col("saved") + (F.col("n") - 1) * F.col("bytes")).alias("saved")).where("leaves <> 0 or saved <> 0")
    # What a node has goes to every node above it within the band; its smallest member has them all on its path.
    blank = {"conv": zero, "n": zero, "kids": zero, "leaves": zero, "saved": zero, "q1": zero, "q2": zero}

    def part(df: DataFrame, **has: Column) -> DataFrame:
        return df.select(*KEY, *[has.get(c, v).alias(c) for c, v in (blank | {"conv": F.lit(None).cast("long"), "q1": F.lit(None).cast("long"), "q2": F.lit(None).cast("long")}).items()])

    sums = here.select("conv", *KEY).join(own, "conv").where(F.col("depth") <= F.col("to"))
    kids = found.where(F.col("depth") > above + 1).select((F.col("depth") - 1).alias("depth"), _parent("p1", "t1"), _parent("p2", "t2"))
    parts = part(found, conv=F.col("conv"), n=F.col("n"), kids=F.col("kids"), q1=F.col("p1").bitwiseXOR(F.col("t1")), q2=F.col("p2").bitwiseXOR(F.col("t2")))
    parts = parts.unionByName(part(sums, leaves=F.col("leaves"), saved=F.col("saved"))).unionByName(part(kids, kids=F.lit(1).cast("long")))
    return staged(parts.groupBy(*KEY).agg(*[F.max(c).alias(c) for c in ("conv", "q1", "q2")], *[F.sum(c).alias(c) for c in ("n", "kids", "leaves", "saved")]))


def trie(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations, the textless root included.

    conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs (members), n_children, n_leaves (childless nodes in the subtree),
    saved_tokens ((members - 1) x bytes of the last text, over the subtree), ends_sha256 (members that end here). Nulls, ties and repeated rows as in
    ``rebuilt``: every row is a turn. A table without conversations has no root, so no rows. Other columns don't matter.
    """
    convs, every = rebuilt(turns, conv, turn, role, text)
    paths = staged(prefixes(every))
    full = paths.where("depth = length").select("conv", *KEY)
    none = convs.where("length = 0").select("conv", *[F.lit(0).cast("long").alias(c) for c in KEY])
    members = staged(full.unionByName(none).join(convs.select("conv", "piece"), "conv"))
    ends = staged(members.groupBy(*KEY).agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n")))
    # Distinct lengths: fewer than the square root of twice the turns.
    lengths = [(r["depth"], r["many"]) for r in ends.groupBy("depth").agg(F.count(F.lit(1)).alias("many")).collect()]
    alive, peeled = None, []
    for above, below in bands(lengths):
        got = _peel(paths, ends, alive, above, below)
        peeled.append(got)
        top = got.where(F.col("depth") == above + 1)
        alive = staged(top.groupBy(F.col("q1").alias("p1"), F.col("q2").alias("p2")).agg(
            F.min("conv").alias("conv"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("kids"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
    zero, unknown = F.lit(0).cast("long"), F.lit(None).cast("long")
    turnless = ends.where("depth = 0").select("conv", "n", *[zero.alias(c) for c in ("kids", "leaves", "saved")])
    left = turnless if alive is None else turnless.unionByName(alive.select("conv", "n", "kids", "leaves", "saved"))  # two rows at most
    root = left.groupBy().agg(F.min("conv").alias("conv"), *[F.sum(c).alias(c) for c in ("n", "kids", "leaves", "saved")]).where("conv is not null")
    root = root.select(*[zero.alias(c) for c in KEY], "conv", unknown.alias("q1"), unknown.alias("q2"), "n", "kids", F.when(F.col("kids") == 0, 1).otherwise(F.col("leaves")).cast("long").alias("leaves"), "saved")
    nodes = staged(root)
    for got in peeled:
        nodes = nodes.unionByName(got)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv").alias("parent"))
    out = nodes.join(digests(members), KEY, "left").join(parents, ["depth", "q1", "q2"], "left")
    return out.select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("kids").alias("n_children"),
                      F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
