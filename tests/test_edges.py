"""Empty inputs, nulls and one-row inputs."""

import pytest
from pyspark.sql import functions as F

from sparkmine.operators import itemsets as I
from sparkmine.operators import relational as R
from sparkmine.operators import seqrules as SR
from sparkmine.operators import sequences as S

ADS = ("campaign_id string, date string, time string, keyword string, display_site string, placement string, "
       "was_clicked int, cpc int, country string")


def test_whole_table_sum_of_nothing_is_one_null_row(spark):
    empty = spark.createDataFrame([], ADS)
    rows = R.total_clicks(empty).collect()
    assert len(rows) == 1 and rows[0].total_clicks is None
    assert R.click_cost_by(empty, "display_site").count() == 0


def test_ctr_counts_only_non_null_first_field(spark):
    df = spark.createDataFrame([(None, "s", 1), ("c", "s", 0), ("c", "s", 1)],
                               "campaign_id string, display_site string, was_clicked int")
    r = R.click_through_rate(df, "display_site").first()
    assert r.ctr == 1.0  # two clicks over two rows with a campaign id


def test_no_frequent_itemsets(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "basket_id long, item string")
    fi = I.frequent_itemsets(df, 0.9)
    assert fi.count() == 0
    assert I.association_rules(fi, 0.1).count() == 0


def test_no_frequent_rules(spark):
    df = spark.createDataFrame([(1, 0, "a"), (2, 0, "b")], "seq_id long, pos long, item string")
    assert SR.sequential_rules(df, 0.9, 0.5).count() == 0


def test_single_visit_user(spark):
    df = spark.createDataFrame([(1, 0, "x")], "user_id long, pos long, category string")
    r = S.category_stats(df).first()
    assert (r.visits, r.refreshes, r.revisits, r.shortest_refresh) == (1, 0, 0, 0)


def test_null_job_title_counts(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",)], "job_title string")
    r = R.distinct_counts(df, "job_title").first()
    assert (r.n_count_distinct, r.n_distinct_rows) == (1, 2)


def test_scale_conf_sizes_partitions():
    from sparkmine.session import scale_conf

    assert scale_conf(10 << 30)["spark.sql.shuffle.partitions"] == "200"
    assert scale_conf(100 << 40)["spark.sql.shuffle.partitions"] == "409600"


def test_no_scratch_folder_of_ones_own_beyond_this_machine(spark, monkeypatch):
    from sparkmine import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_null_items_are_left_out_on_both_paths(spark):
    rows = [(b, i) for b in range(6) for i in ("a", "b", None)] + [(9, None), (9, "a")]
    baskets = spark.createDataFrame(rows, "basket_id long, item string")
    seqs = spark.createDataFrame([(b, p, i) for b in range(6) for p, i in enumerate((None, "a", None, "b"))], "seq_id long, pos long, item string")
    sets, rules = [], []
    for mask in (62, 0):
        sets.append(sorted(map(str, I.frequent_itemsets(baskets, 0.3, mask_items=mask).collect())))
        rules.append(sorted(map(str, SR.sequential_rules(seqs, 0.5, 0.5, mask_items=mask).collect())))
    assert sets[0] == sets[1] and len(sets[0]) == 3 and rules[0] == rules[1] and len(rules[0]) == 1


def test_rules_of_large_sets(spark):
    """A set of 24 items has 16 million rules, of which one is confident."""
    items = [f"i{k:02}" for k in range(24)]
    sets = [(items, 24, 10)] + [(items[:k] + items[k + 1:], 23, 10 if k == 5 else 100) for k in range(24)]
    df = spark.createDataFrame(sets, "items array<string>, size int, support long")
    rules = I.association_rules(df, 0.9).collect()
    assert [(r.consequent, r.confidence) for r in rules] == [(["i05"], 1.0)]


def test_level_tables_have_a_file_for_each_bucket_and_go_with_their_scope(spark, monkeypatch):
    from sparkmine import session

    monkeypatch.setattr(session, "BROADCAST_BYTES", 0)  # every level takes the shuffle branch
    baskets = spark.range(3000).selectExpr("id div 3 as basket_id", "concat('i', id * 7 % 13) as item")
    before = {t.name for t in spark.catalog.listTables()}
    kept_before = spark.sparkContext._jsc.getPersistentRDDs().size()
    with session.scratch(spark) as scope:
        expected = sorted(map(str, I.frequent_itemsets(baskets, 0.001).collect()))
        tables = [path for _, path in scope.tables]
        assert len(tables) >= 2
        for path in tables:
            files = spark.read.parquet(path).select("_metadata.file_path").distinct().count()
            assert files <= session.shuffle_partitions(spark)
    assert {t.name for t in spark.catalog.listTables()} == before
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept_before
    monkeypatch.undo()
    assert sorted(map(str, I.frequent_itemsets(baskets, 0.001).collect())) == expected


@pytest.mark.parametrize("mask", [62, 0])
def test_hot_baskets_and_sequences_are_spread(spark, mask):
    """One basket (sequence) holds a third of all rows; its join runs in many tasks."""
    from sparkmine.operators import spread

    rows = [(b, f"i{(b + k) % 30:02}") for b in range(40) for k in range(4)] + [(99, f"i{k:02}") for k in range(30)] * 3
    baskets = spark.createDataFrame(rows, "basket_id long, item string")
    seqs = spark.createDataFrame([(b, p, i) for p, (b, i) in enumerate(rows)], "seq_id long, pos long, item string")

    def mine():
        return [sorted(map(str, I.frequent_itemsets(baskets, 0.05, max_size=3, mask_items=mask).collect())),
                sorted(map(str, SR.sequential_rules(seqs, 0.05, 0.1, 2, 2, mask_items=mask).collect()))]

    expected = mine()
    spark.conf.set("sparkmine.spread.hotItems", "10")
    try:
        assert mine() == expected and all(expected)
        hot = spread.hot_keys(baskets.distinct(), "basket_id")
        assert [r[0] for r in hot.collect()] == [99]
        left = baskets.distinct().filter("basket_id = 99")
        for key, value in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.coalescePartitions.enabled", "false")):
            spark.conf.set(key, value)  # as with tables that are not this small
        salted = spread.spread_join(left, left.withColumnRenamed("item", "other"), "basket_id", hot)
        assert salted.select(F.spark_partition_id()).distinct().count() > 1 and salted.count() == 900
    finally:
        spark.conf.unset("sparkmine.spread.hotItems")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
