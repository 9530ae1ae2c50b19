"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerscope.operators.joins import probable_rows, table_bytes
from offerscope.session import materialize

#: A table is broadcast when its measured size is at most this.
BROADCAST_BYTES = 16 * 1024 * 1024
#: The same where many such tables follow one another: the driver makes each a hash table of
#: up to four times its size and holds it until garbage is collected.
REPEATED_BROADCAST_BYTES = 4 * 1024 * 1024
#: Copies of the smaller side when a join is shuffled, so that a hot key spreads.
SALTS = 32


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def plain(name: str) -> Column:
    """The top-level column of that name, also if the name has dots."""
    return F.col("`" + name.replace("`", "``") + "`")


#: Rows of a file that a row number has room for.
FILE_ROWS = 1 << 40


def numbered(df: DataFrame, number: str) -> DataFrame:
    """``df`` with a long column ``number``, different in each row and the same whenever
    the result is read, however its scan is split then.

    The rows of a table in parquet files are numbered by the place of their file among
    the sorted file names and by their place in the file. Rows of anything else are
    written once with their numbers. Driver memory: a name per file.
    """
    analyzed = df._jdf.queryExecution().analyzed()
    if analyzed.getClass().getSimpleName() == "LogicalRelation" and df.inputFiles():
        try:
            meta = df.metadataColumn("_metadata")
            path, at = meta["file_path"], meta["row_index"]
            # a file that is read twice, say, has more rows than places
            files = df.groupBy(path.alias("path")).agg(F.count(F.lit(1)).alias("n"), F.max(at).alias("last")).collect()
        except AnalysisException:  # no places in these files
            files = None
        if files is not None and all(row["n"] == row["last"] + 1 <= FILE_ROWS for row in files):
            file, base = free_name(df, "file"), free_name(df, "base")
            known = [(row["path"], k * FILE_ROWS) for k, row in enumerate(sorted(files, key=lambda row: row["path"]))]
            bases = df.sparkSession.createDataFrame(known, T.StructType([T.StructField(file, T.StringType()), T.StructField(base, T.LongType())]))
            placed = df.select("*", path.alias(file), at.alias(number))
            # left, so that no row can be lost; every file has its base
            placed = placed.join(F.broadcast(bases), file, "left")
            return placed.select(*[plain(c) for c in df.columns], (plain(base) + plain(number)).alias(number))
    return materialize(df.withColumn(number, F.monotonically_increasing_id()), "numbered")


def measured_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str,
    salt_by: str,
    limit: int = BROADCAST_BYTES,
    salts: int = SALTS,
    at_most: int | None = None,
    few_match: bool = False,
) -> DataFrame:
    """Join ``big`` with ``small``, which must be materialised unless ``at_most``, a
    proven bound of its bytes, is given; else it is measured.

    ``small`` is broadcast when it takes at most ``limit`` bytes. Beyond that both
    sides are shuffled on the key and a salt, drawn from ``salt_by`` of the big side,
    so that a key with a third of the rows spreads over ``salts`` tasks. The rows are
    the same either way. ``how``: inner, left, left_semi or left_anti. With ``few_match``,
    for the kinds that keep matches only, rows of ``big`` whose key is surely not in
    ``small`` are dropped before they are shuffled; ``small`` must be materialised then.
    """
    if (table_bytes(small) if at_most is None else at_most) <= limit:
        return big.join(F.broadcast(small), on, how)
    if few_match:
        if how not in ("inner", "left_semi"):
            raise ValueError(f"rows without a match stay in a join of kind {how}")
        big = probable_rows(big, small, on)
    salt = F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int")
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return big.withColumn("_salt", salt).join(copies, [*on, "_salt"], how).drop("_salt")


#: Bytes that a row of up to three long columns takes in a broadcast table, with room to spare.
NARROW_ROW = 64


def connected_components(edges: DataFrame, limit: int = REPEATED_BROADCAST_BYTES) -> DataFrame:
    """``node, component`` for every node of ``edges`` (columns ``u, v``, both long and
    not null); the component is its smallest node.

    Alternating large-star and small-star: a large star links the larger
    neighbours of every node to its smallest neighbour, a small star the smaller
    ones. Rounds go on until the edges are stars, about log(n) of them. Every
    round is written to the shared folder, so lineage stays short. A hub's edges
    are never in one task: its minimum comes from partial minima, and is joined by
    broadcast or over salts.
    """

    def star(around: DataFrame, count: int, larger: bool) -> DataFrame:
        """Links what is around each ``u`` to the smallest of it."""
        least = around.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        bound = 2 * count * NARROW_ROW
        if bound > limit:
            least = materialize(least, "least")
        moved = around.filter("v > u") if larger else around
        moved = measured_join(moved, least, ["u"], "inner", "v", limit, at_most=bound)
        moved = moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
        if not larger:
            moved = moved.unionByName(least.select("u", F.col("m").alias("v")))
        return materialize(_oriented(moved), "edges")

    now = materialize(_oriented(edges), "edges")
    count, done = _shape(now)
    while not done:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        now = star(both, count, True)
        now = star(now, count, False)  # a star never makes more edges than there were
        count, done = _shape(now)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _oriented(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node, without loops."""
    ends = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return ends.filter("u > v").distinct()


def _shape(edges: DataFrame) -> tuple[int, bool]:
    """How many edges there are, and whether they are stars already: every larger node has
    one edge, and no smaller node is a larger one of another edge."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    ends = edges.select(F.col("u").alias("node"), one.alias("larger"), none.alias("smaller"))
    ends = ends.unionByName(edges.select(F.col("v").alias("node"), none.alias("larger"), one.alias("smaller")))
    nodes = ends.groupBy("node").agg(F.sum("larger").alias("larger"), F.max("smaller").alias("smaller"))
    row = nodes.agg(F.sum("larger"), F.max((F.col("larger") + F.col("smaller") > 1) & (F.col("larger") > 0))).first()
    return row[0] or 0, not row[1]
