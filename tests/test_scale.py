"""Steps whose moved bytes or memory must not grow faster than the rows."""

from sparkplate.operators import als as M
from sparkplate.operators import split as SP
from sparkplate.plans import ingest_queries as IQ
from sparkplate.plans import registry as G
from sparkplate.session import cut_lineage, shuffle_tasks

from conftest import SMALL


def test_null_names_are_sought_before_restaurants_are_joined(spark):
    plan = G.QUERIES["check_not_null_user_name"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    assert "_rid" in joins[0] and "_uid" in joins[1]


def test_raw_files_are_compressed_and_tips_equal_reviews(spark):
    folder = IQ.raw_datasets(spark, SMALL)
    for name in ("business", "user", "review", "checkin", "tip"):
        assert all(f.endswith(".json.gz") for f in spark.read.text(f"{folder}/{name}.json").inputFiles())
    tips = spark.read.json(f"{folder}/tip.json").select("user_id", "business_id", "text", "date", "compliment_count")
    review = IQ.analogs.an_review(spark, SMALL).select("user_id", "business_id", "text", "date", "cool")
    assert sorted(map(tuple, tips.collect())) == sorted(map(tuple, review.collect()))


def test_distinct_rows_take_tasks_by_rows(spark, monkeypatch):
    monkeypatch.setattr(SP, "ROWS_PER_TASK", 100)
    df = cut_lineage(spark.range(4000).selectExpr("id % 1500 AS a", "IF(id % 1500 = 7, NULL, 'x') AS b"))
    found = SP.distinct_rows(df)
    assert found.rdd.getNumPartitions() == 40
    assert found.count() == 1500


def test_split_joins_take_tasks_by_rows(spark, monkeypatch):
    """The joins that make the ratings ran in the session's number of tasks, however many rows."""
    seen, rows, number = {}, 300, "spark.sql.shuffle.partitions"
    ratings = cut_lineage(spark.range(rows).selectExpr(
        "concat('b', id % 50) AS business_id", "concat('u', id % 40) AS user_id", "id % 5 + 1 AS stars",
        "concat('2024-01-', 10 + id % 20) AS date", "id % 40 AS userid", "id % 50 AS businessid"))
    want = [sorted(map(tuple, x.collect())) for x in SP.time_split(ratings)]
    monkeypatch.setattr(SP, "ROWS_PER_TASK", 10)
    write = SP.cut_lineage
    monkeypatch.setattr(SP, "cut_lineage", lambda df: seen.setdefault(len(seen), spark.conf.get(number)) and write(df))
    before = spark.conf.get(number)
    for n in (None, rows, 2 * rows):
        seen.clear()
        assert [sorted(map(tuple, x.collect())) for x in SP.time_split(ratings, rows=n)] == want
        assert seen[0] == str((n or rows) // 10) and seen[1] == before == spark.conf.get(number)


def test_shuffle_tasks_are_given_back(spark):
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = [spark.conf.get(k) for k in keys]
    for tasks, inside in ((97, ["97", "false"]), (1, before)):
        try:
            with shuffle_tasks(spark, tasks):
                assert [spark.conf.get(k) for k in keys] == inside
                raise RuntimeError
        except RuntimeError:
            assert [spark.conf.get(k) for k in keys] == before


def test_factor_blocks_follow_the_ratings(spark, monkeypatch):
    ratings = spark.range(1000)
    assert M._blocks(ratings, None) == M.NUM_BLOCKS and M._blocks(ratings, 3) == 3
    monkeypatch.setattr(M, "BLOCK_RATINGS", 50)
    assert M._blocks(ratings, None) == 20


def test_training_reads_three_written_columns(spark):
    rows = M._training_rows(G.shared_ratings(spark, SMALL), "userid", "businessid", "stars")
    assert rows.columns == ["userid", "businessid", "stars"]
    assert "Join" not in rows._jdf.queryExecution().optimizedPlan().toString()
