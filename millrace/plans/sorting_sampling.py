"""Sort, limit, top-k, samples and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators.sampling import sample_blocks, sample_files, sample_fraction, sample_n, with_split
from millrace.plans.registry import query
from millrace.session import scratch_dir, table

HASH = "('0x' || substr(md5({key} || '|{seed}'), 1, 8))::bigint"


@query("sort_multi", "select o_orderkey, o_totalprice, o_orderdate from orders order by 2 desc, 3 desc, 1")
def sort_multi(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderdate").orderBy(
        F.desc_nulls_first("o_totalprice"), F.desc_nulls_first("o_orderdate"), F.asc_nulls_last("o_orderkey"))


@query("topk", """
    select l_orderkey, l_partkey, l_linenumber, l_extendedprice from lineitem
    order by l_extendedprice desc, l_orderkey, l_partkey, l_linenumber limit 10
""")
def topk(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice").orderBy(
        F.desc("l_extendedprice"), "l_orderkey", "l_partkey", "l_linenumber").limit(10)


@query("limit_offset", "select c_custkey, c_acctbal from customer order by c_acctbal, c_custkey limit 7 offset 7")
def limit_offset(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", "c_acctbal").orderBy("c_acctbal", "c_custkey").offset(7).limit(7)


@query("head", "select 5::bigint as n, true as members")
def head(spark, sf):
    """Any five rows: as many as asked for, all of them rows of the table."""
    orders = table(spark, sf, "orders")
    some = orders.limit(5)
    found = some.join(orders.select(F.col("o_orderkey").alias("key")), F.col("o_orderkey") == F.col("key"), "left")
    return found.agg(F.count("*").alias("n"), F.every(F.col("key").isNotNull()).alias("members"))


@query("sample_frac", "select count(*) as rows, true as within, true as members from lineitem")
def sample_frac(spark, sf):
    """An unseeded sample: its size is within six deviations of the fraction, and it holds no row more often than the table."""
    lines = table(spark, sf, "lineitem")
    key = ["l_orderkey", "l_partkey", "l_linenumber"]
    drawn = lines.sample(0.01).groupBy(*key).agg(F.count("*").alias("drawn"))
    held = lines.groupBy(*key).agg(F.count("*").alias("held"))
    counted = held.join(drawn, key, "left").agg(
        F.sum("held").alias("rows"), F.sum(F.coalesce("drawn", F.lit(0))).alias("drawn"), F.every(F.coalesce("drawn", F.lit(0)) <= F.col("held")).alias("members"))
    bound = 6 * F.sqrt(F.col("rows") * 0.01 * 0.99) + 1
    return counted.select("rows", (F.abs(F.col("drawn") - F.col("rows") * 0.01) <= bound).alias("within"), "members")


@query("sample_seeded", f"select o_orderkey, o_totalprice from orders where {HASH.format(key='o_orderkey', seed=400)} < 858993459")
def sample_seeded(spark, sf):
    return sample_fraction(table(spark, sf, "orders"), 0.2, ["o_orderkey"], seed=400).select("o_orderkey", "o_totalprice")


@query("sample_n", f"select event_id, user_id from events order by {HASH.format(key='event_id', seed=0)}, event_id limit 500")
def sample_n_query(spark, sf):
    return sample_n(table(spark, sf, "events"), 500, ["event_id"]).select("event_id", "user_id")


@query("sample_block", "select count(*) as rows, true as whole from lineitem")
def sample_block(spark, sf):
    """Every block of rows is in the sample as a whole or not at all."""
    lines = table(spark, sf, "lineitem")
    block = F.struct(F.col("_metadata.file_name").alias("file"), F.floor(F.col("_metadata.row_index") / 1024).alias("run")).alias("block")
    drawn = sample_blocks(lines, 0.1, seed=1).select(block).groupBy("block").agg(F.count("*").alias("drawn"))
    held = lines.select(block).groupBy("block").agg(F.count("*").alias("held"))
    return held.join(drawn, "block", "left").agg(F.sum("held").alias("rows"), F.every(F.coalesce("drawn", "held") == F.col("held")).alias("whole"))


@query("sample_block_files", "select count(*) as rows, true as whole, true as apart from lineitem")
def sample_block_files(spark, sf):
    """The table as many files, of which a third is drawn: drawn files come whole, and another seed draws other files."""
    path = scratch_dir(spark, "blocks")
    table(spark, sf, "lineitem").repartition(spark.sparkContext.defaultParallelism).write.option("maxRecordsPerFile", 500).parquet(path)
    lines, file = spark.read.parquet(path), F.col("_metadata.file_name").alias("file")

    def counted(scan, name):
        return scan.select(file).groupBy("file").agg(F.count("*").alias(name))

    held = counted(lines, "held")
    for seed in (1, 2):
        held = held.join(counted(sample_files(lines, 1 / 3, seed), f"drawn{seed}"), "file", "left")
    first, second = F.col("drawn1").isNotNull(), F.col("drawn2").isNotNull()
    return held.agg(
        F.sum("held").alias("rows"),
        F.every((F.coalesce("drawn1", "held") == F.col("held")) & (F.coalesce("drawn2", "held") == F.col("held"))).alias("whole"),
        (F.count_if(first != second) > 0).alias("apart"))


@query("split_random", f"""
    select case when h < 3435973836 then 0 else 1 end as part, count(*) as n, sum(o_orderkey)::bigint as keys
    from (select o_orderkey, {HASH.format(key='o_orderkey', seed=42)} as h from orders) group by 1
""")
def split_random(spark, sf):
    parts = with_split(table(spark, sf, "orders"), [0.8, 0.2], ["o_orderkey"], seed=42, name="part")
    return parts.groupBy("part").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))
