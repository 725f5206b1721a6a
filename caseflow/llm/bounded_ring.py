"""Operator 1: sharding on a consistent-hash ring with bounded loads.

Each shard has ``VNODES`` points on a ring of ``CELLS`` cells; a row falls into
the cell of its key's hash, and the first point clockwise owns the arc it lies
in.  Loads are bounded: a shard takes ``floor`` or ``ceil`` of rows / shards (or,
with ``slack``, up to ``(1 + slack)`` times the mean), and what overflows a full
shard continues clockwise to the next points until one has room.

Everything per row is a DataFrame operation.  Rows are counted per cell; only the
loads of the arcs, at most shards * ``VNODES`` numbers, reach the driver, which
plans the overflow and sends back *pieces*: intervals of an arc's rows with the
shard and the first slot they go to.  A row finds its piece by its rank inside its
arc: the offset of its sub-cell (at most ``CELLS * SUBCELLS`` rows, broadcast)
plus its rank inside the sub-cell, a window over a small part of the rows.  A
sub-cell comes from a hash of all carried columns, so a hot key is spread over
sub-cells; rows equal in every carried column are counted, numbered together and
expanded again.

:func:`ordered_digest` numbers the slots of each shard in the order of the Parquet it
reads (part file, then row): rows are counted per (shard, file, run of ``RUN_ROWS``
rows), the counts give offsets, and a window ranks the rows of a run only.

Defined results: null keys hash like any other value; repeated rows each get a
slot of their own; an empty table gives no rows; ``carry`` names the columns to
return, and an input column named like an output column (``shard``, ``slot``) is
not carried.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caseflow.llm.common import local_rows
from caseflow.session import stage

VNODES, CELLS, SUBCELLS = 64, 4096, 16
SHARDS = 16
RUN_ROWS = 65_536


def ring_points(df: DataFrame, n_shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, clockwise."""
    spark = df.sparkSession
    points = spark.range(n_shards * vnodes).select(
        (F.col("id") / vnodes).cast("int").alias("shard"), F.xxhash64(F.concat_ws("/", F.lit("point"), F.col("id").cast("string"))).alias("h")
    )
    found = points.select(F.pmod("h", F.lit(CELLS)).cast("int").alias("cell"), "h", "shard").collect()
    return [(r["cell"], r["shard"]) for r in sorted(found)]


def plan_pieces(loads: list[int], owners: list[int], room: list[int]) -> list[dict]:
    """Pieces of arcs for shards: an arc's rows go to the next points clockwise that have room."""
    pieces, done, fill = [], [0] * len(loads), [0] * len(room)
    for step in range(len(loads)):
        if done == loads:
            break
        for a, load in enumerate(loads):
            shard = owners[(a + step) % len(owners)]
            n = min(load - done[a], room[shard] - fill[shard])
            if n > 0:
                pieces.append({"arc": a, "lo": done[a], "hi": done[a] + n, "shard": shard, "base": fill[shard]})
                done[a] += n
                fill[shard] += n
    return pieces


def capacities(total: int, n_shards: int, slack: float) -> list[int]:
    if slack > 0:
        return [-(-int(total * (1 + slack)) // n_shards) + 1] * n_shards
    return [total // n_shards + (s < total % n_shards) for s in range(n_shards)]


def assign_shards(df: DataFrame, n_shards: int, key: str = "doc_id", carry: list[str] | None = None, vnodes: int = VNODES, slack: float = 0.0) -> DataFrame:
    """``carry`` columns plus ``shard int`` and ``slot long`` (gapless from 0 in each shard)."""
    names = [c for c in (carry or df.columns) if c not in ("shard", "slot")]
    inner = [f"_c{i}" for i in range(len(names))]
    cells = [F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(CELLS)).cast("int").alias("_cell")]
    rows = df.select(*[F.col(c).alias(x) for c, x in zip(names, inner, strict=True)], *cells)
    rows = stage(rows.withColumn("_sub", F.pmod(F.xxhash64(*inner, F.lit(1)), F.lit(SUBCELLS)).cast("int")))

    points = ring_points(df, n_shards, vnodes)
    owners = [s for _, s in points]
    arc_of, a = [], 0
    for cell in range(CELLS):
        while a < len(points) and points[a][0] < cell:
            a += 1
        arc_of.append({"_cell": cell, "arc": a % len(points)})
    arcs = local_rows(df.sparkSession, arc_of, "_cell int, arc int")

    counts = rows.groupBy("_cell", "_sub").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(arcs), "_cell")
    before = Window.partitionBy("arc").orderBy("_cell", "_sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stage(counts.withColumn("off", F.coalesce(F.sum("n").over(before), F.lit(0))))
    loads = [0] * len(points)
    for r in offsets.groupBy("arc").agg(F.sum("n").alias("n")).collect():
        loads[r["arc"]] = r["n"]
    pieces = local_rows(df.sparkSession, plan_pieces(loads, owners, capacities(sum(loads), n_shards, slack)), "arc int, lo long, hi long, shard int, base long")

    same = rows.groupBy("_cell", "_sub", *inner).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy("_cell", "_sub").orderBy(F.xxhash64(*inner), *inner).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = same.withColumn("_rank", F.sum("_n").over(upto) - F.col("_n"))
    placed = ranked.join(F.broadcast(offsets.select("_cell", "_sub", "arc", "off")), ["_cell", "_sub"])
    each = placed.select(*inner, "arc", F.explode(F.sequence(F.col("off") + F.col("_rank"), F.col("off") + F.col("_rank") + F.col("_n") - 1)).alias("at"))
    found = each.join(F.broadcast(pieces), "arc").where("at >= lo and at < hi")
    return found.select(*[F.col(x).alias(c) for x, c in zip(inner, names, strict=True)], "shard", (F.col("base") + F.col("at") - F.col("lo")).alias("slot"))


def digest_columns(docs: DataFrame) -> list[F.Column]:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return [F.col("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).cast("long").alias("text_crc32")]


def as_digest(placed: DataFrame) -> DataFrame:
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def shard_digest(docs: DataFrame, n_shards: int = SHARDS) -> DataFrame:
    """Shards by the ``rows`` law: counts are at most one apart."""
    return as_digest(assign_shards(docs.select(*digest_columns(docs)), n_shards))


def with_place(docs: DataFrame) -> DataFrame:
    """The digest's columns with the place of each row in the Parquet folder: ``_file`` and ``_at``.

    Spark packs files into tasks by size, so the order of the read rows is not the
    order of the folder; the names of the part files and the rows' numbers are.
    Only a plain read shows them: other frames are written first.
    """
    plan = docs._jdf.queryExecution().analyzed()
    if not plan.children().isEmpty():
        docs = stage(docs)
    try:
        files = docs.metadataColumn("_metadata")
        name, at = files["file_name"], files["row_index"]
        docs.select(at)
    except AnalysisException:  # not read from Parquet files
        docs = stage(docs)
        files = docs.metadataColumn("_metadata")
        name, at = files["file_name"], files["row_index"]
    number = lambda pattern: F.coalesce(F.regexp_extract(name, pattern, 1).try_cast("long"), F.lit(0))
    return docs.select(*digest_columns(docs), (number(r"part-(\d+)") * 2**20 + number(r"-c(\d+)\.")).alias("_file"), at.alias("_at"))


def ordered_digest(docs: DataFrame, n_shards: int = SHARDS) -> DataFrame:
    """Like :func:`shard_digest`, with the slots of each shard in the order of the Parquet that ``docs`` reads."""
    placed = stage(assign_shards(with_place(docs), n_shards).drop("slot").withColumn("_run", F.floor(F.col("_at") / RUN_ROWS)))
    run = ["shard", "_file", "_run"]
    before = Window.partitionBy("shard").orderBy("_file", "_run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(*run).agg(F.count(F.lit(1)).alias("n")).select(*run, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_off"))
    ranked = placed.withColumn("_rank", F.row_number().over(Window.partitionBy(*run).orderBy("_at")) - 1)
    return as_digest(ranked.join(offsets, run).withColumn("slot", F.col("_off") + F.col("_rank")))
