"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix."""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from formline.operators.layout import stored

# Input partitions are counted together in at most this many blocks, which bounds the matrix.
MAX_BLOCKS = 4096
# Rows that one task puts into order within a shard.
RUN_ROWS = 200_000


def communication_matrix(rows: list[int], shard_rows: list[int], seed: int) -> np.ndarray:
    """How many rows each block sends to each shard when all rows are dealt uniformly at random.

    Block after block draws from what the shards still need: a multivariate hypergeometric draw, so the
    matrix has the distribution of a uniform permutation, and its margins are exactly the given counts.
    """
    draw = np.random.Generator(np.random.PCG64(seed))
    left, matrix = np.array(shard_rows, np.int64), []
    for n in rows:
        sent = _draw(draw, left, n)
        matrix.append(sent)
        left = left - sent
    return np.array(matrix, np.int64).reshape(len(rows), len(shard_rows))


def _draw(draw: np.random.Generator, left: np.ndarray, n: int) -> np.ndarray:
    """One multivariate hypergeometric draw, shard by shard. numpy draws up to 1e9 at once; more come in parts."""
    left, total = left.copy(), np.zeros(len(left), np.int64)
    while n > 0:
        part, rest, taken = min(n, 400_000_000), int(left.sum()), np.zeros(len(left), np.int64)
        need = part
        for k, have in enumerate(left.tolist()):
            others = rest - have
            if need == 0:
                break
            if max(have, others) < 1_000_000_000:
                got = int(draw.hypergeometric(have, others, need)) if rest else 0
            else:  # beyond numpy's range the share of a part this small is binomial up to 1e-9
                got = int(np.clip(draw.binomial(need, have / rest), max(0, need - others), min(have, need)))
            taken[k], need, rest = got, need - got, others
        left, total, n = left - taken, total + taken, n - part
    return total


def shard_uniformly(df: DataFrame, shards: int, seed: int = 0, run_rows: int = RUN_ROWS) -> DataFrame:
    """All rows and columns of ``df`` with ``shard`` (0 to shards - 1) and ``slot`` (0, 1, ... within its shard).

    Shard sizes differ by one row at most, and every arrangement is equally likely.
    1. Rows are put into random order within their input partition, numbered there, and written to the
       shared folder, so that counts and rows agree whatever happens to executors later.
    2. The driver sees one count per block of partitions (at most 4096) and draws the matrix.
    3. A row's number and the matrix row of its block give its shard: no other row is looked at. Where blocks
       hold several partitions, their rows are first numbered in a random order of the whole block.
    4. Within a shard rows get a second random order: cut by leading hash bits into runs of about
       ``run_rows`` rows, numbered within the run, and shifted by the rows of the runs before it.

    Equal rows, null values and repeated ids are ordinary rows. An empty table gives an empty table. Columns
    of ``df`` named shard or slot are replaced; names that begin with _sh_ are reserved. Hashes are over the
    row's number as well as its columns, so repeated rows are dealt independently.
    """
    columns = [c for c in df.columns if c not in ("shard", "slot")]
    sortable = [c for c, kind in df.dtypes if c in columns and "map<" not in kind and kind != "variant"]
    key = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in sortable])
    ordered = df.select(*[F.col(f"`{c}`") for c in columns]).withColumn("_sh_at", F.monotonically_increasing_id())
    ordered = ordered.withColumn("_sh_key", F.xxhash64(key, F.col("_sh_at"))).sortWithinPartitions("_sh_key", "_sh_at")
    numbered = ordered.withColumn("_sh_id", F.monotonically_increasing_id()).drop("_sh_at").select(
        "*", F.shiftright("_sh_id", 33).alias("_sh_part"), F.col("_sh_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_sh_row"))
    numbered = stored(numbered.drop("_sh_id"), "numbered")

    parts = numbered.groupBy("_sh_part").agg(F.count(F.lit(1)).alias("_sh_rows"))
    parts = parts.withColumn("_sh_block", F.pmod(F.col("_sh_part"), F.lit(MAX_BLOCKS)))
    held = parts.groupBy("_sh_block").agg(F.sum("_sh_rows"), F.count(F.lit(1))).collect()
    counts, shared = {r[0]: r[1] for r in held}, any(r[2] > 1 for r in held)
    blocks, total = sorted(counts), sum(counts.values())
    sizes = [total // shards + (k < total % shards) for k in range(shards)]
    matrix = communication_matrix([counts[b] for b in blocks], sizes, seed)
    cuts = json.dumps([{"_sh_block": b, "_sh_cuts": c} for b, c in zip(blocks, np.cumsum(matrix, axis=1).tolist())])

    table = df.sparkSession.range(1).select(F.inline(F.from_json(F.lit(cuts), "array<struct<_sh_block:bigint,_sh_cuts:array<bigint>>>")))
    if shared:  # partitions laid one after the other would reach neighbouring shards only
        mixed = F.xxhash64(F.lit(seed + 2), F.col("_sh_key"), F.col("_sh_part"), F.col("_sh_row"))
        whole = Window.partitionBy("_sh_block").orderBy("_sh_mixed", "_sh_part", "_sh_row")
        dealt = numbered.withColumn("_sh_block", F.pmod(F.col("_sh_part"), F.lit(MAX_BLOCKS))).withColumn("_sh_mixed", mixed)
        dealt = dealt.withColumn("_sh_n", F.row_number().over(whole) - 1).join(table, "_sh_block").drop("_sh_mixed", "_sh_block")
    else:
        dealt = numbered.join(parts.join(table, "_sh_block").select("_sh_part", "_sh_cuts"), "_sh_part").withColumn("_sh_n", F.col("_sh_row"))
    dealt = dealt.withColumn("shard", F.size(F.filter("_sh_cuts", lambda x: x <= F.col("_sh_n"))).cast("int")).drop("_sh_cuts", "_sh_n")

    runs = max(1, math.ceil(total / shards / run_rows))
    again = F.xxhash64(F.lit(seed + 1), F.col("_sh_key"), F.col("_sh_part"), F.col("_sh_row"))
    dealt = dealt.withColumn("_sh_again", again).withColumn(
        "_sh_run", F.floor(F.pmod(F.shiftright("_sh_again", 20), F.lit(1 << 30)) * runs / F.lit(float(1 << 30))).cast("int"))
    dealt = stored(dealt.drop("_sh_key"), "dealt")
    run_counts = dealt.groupBy("shard", "_sh_run").agg(F.count(F.lit(1)).alias("_sh_size"))
    earlier = Window.partitionBy("shard").orderBy("_sh_run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = run_counts.select("shard", "_sh_run", F.coalesce(F.sum("_sh_size").over(earlier), F.lit(0)).alias("_sh_base"))
    within = Window.partitionBy("shard", "_sh_run").orderBy("_sh_again", "_sh_part", "_sh_row")
    placed = dealt.withColumn("_sh_at", F.row_number().over(within) - 1).join(offsets, ["shard", "_sh_run"])
    return placed.select(*[F.col(f"`{c}`") for c in columns], "shard", (F.col("_sh_base") + F.col("_sh_at")).alias("slot"))
