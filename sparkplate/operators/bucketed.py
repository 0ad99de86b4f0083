"""A star join that does not shuffle the fact again (J4): silver tables stored in buckets.

``store_star`` writes the fact and the restaurant dimension in the same number of buckets of
(restaurant_id, salt), so that every later join of the two reads bucket by bucket, with no
exchange on either side. A key with more rows than a bucket's fair share would fill one task; it
is dealt over several salts by a hash of the row, and the dimension holds its row once per salt.
There are fewer such keys than buckets, so their list is a bounded broadcast. Salts are stored:
a reader joins on both columns and never sees them.

The shuffle is paid once, when the tables are written. Columns of the user dimension are joined
as before (AQE broadcasts it by size, else shuffles); no chart reads them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkplate.operators.gold import GOLD_RESTAURANT_COLUMNS

SALT = "_salt"


def hot_keys(fact: DataFrame, key: str, buckets: int) -> DataFrame:
    """(key, salts) of the keys with more than 1 / ``buckets`` of the rows: fewer than ``buckets`` keys."""
    counts = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    fair = max(1, -(-fact.count() // buckets))
    return counts.where(F.col("_n") > fair).select(key, F.least(F.ceil(F.col("_n") / fair), F.lit(buckets)).cast("int").alias("_salts"))


def salted_fact(fact: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """The fact with its salt; a null key matches nothing and is dealt over all salts of its rows."""
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in fact.columns]), F.coalesce("_salts", F.when(F.col(key).isNull(), 1024), F.lit(1)))
    return fact.join(F.broadcast(hot), key, "left").withColumn(SALT, spread.cast("int")).select(*fact.columns, SALT)


def salted_dim(dim: DataFrame, hot: DataFrame, key: str) -> DataFrame:
    """The dimension with a row for each salt of its key."""
    salts = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    return dim.join(F.broadcast(hot), key, "left").select(*dim.columns, F.explode(salts).alias(SALT))


def store_star(fact: DataFrame, dim_restaurant: DataFrame, fact_table: str, dim_table: str, buckets: int = 64,
               fmt: str = "parquet") -> None:
    """Write both tables in ``buckets`` buckets of (restaurant_id, salt), sorted inside."""
    key = "restaurant_id"
    hot = hot_keys(fact, key, buckets)
    for df, name in ((salted_fact(fact, hot, key), fact_table), (salted_dim(dim_restaurant, hot, key), dim_table)):
        # one task a bucket, so one file each and no sort at the join
        (df.repartition(buckets, key, SALT).write.format(fmt).mode("overwrite")
         .bucketBy(buckets, key, SALT).sortBy(key, SALT).saveAsTable(name))


def bucketed_gold(spark: SparkSession, fact_table: str, dim_table: str) -> DataFrame:
    """The fact with its restaurant columns (J4 without the user's), joined bucket by bucket."""
    fact, dim = spark.table(fact_table), spark.table(dim_table)
    carried = [(c, g) for c, g in GOLD_RESTAURANT_COLUMNS if c in dim.columns]
    right = dim.select(F.col("restaurant_id").alias("_rid"), F.col(SALT).alias("_rsalt"), *[F.col(c).alias(f"_dr_{c}") for c, _ in carried])
    joined = fact.join(right.hint("merge"), (fact["restaurant_id"] == F.col("_rid")) & (fact[SALT] == F.col("_rsalt")), "left")
    return joined.select(*[c for c in fact.columns if c != SALT], *[F.col(f"_dr_{c}").alias(g) for c, g in carried])
