import pytest
from pyspark.sql import functions as F

from riskweave.operators import preprocess


def labelled(spark, n, positives):
    return spark.range(n).select(F.col("id").alias("key"), (F.col("id") < positives).cast("int").alias("y"))


@pytest.mark.parametrize("n, positives", [(1000, 3), (500, 250), (10, 2), (7, 1)])
def test_split_takes_the_exact_share_of_each_class(spark, n, positives):
    split = preprocess.stratified_split(labelled(spark, n, positives), "y", "key")
    found = {(r["split"], r["y"]): r["count"] for r in split.groupBy("split", "y").count().collect()}
    for label, size in ((1, positives), (0, n - positives)):
        wanted = min(max(int(size * 0.2 + 0.5), 1), size - 1)
        assert found.get(("validation", label), 0) == wanted
        assert found.get(("train", label), 0) == size - wanted
    assert split.columns == ["key", "y", "split"]


def test_split_depends_on_key_and_seed_only(spark):
    df = labelled(spark, 200, 40)

    def chosen(frame, seed=42):
        split = preprocess.stratified_split(frame, "y", "key", seed=seed)
        return {r["key"] for r in split.where("split = 'validation'").collect()}

    assert chosen(df) == chosen(df.repartition(7)) and chosen(df) != chosen(df, seed=1)


def test_too_few_positives(spark):
    with pytest.raises(ValueError, match="Not enough positive"):
        preprocess.require_positives(labelled(spark, 10, 1), "y")


def test_modes_medians_scaling_and_unseen_categories(spark):
    train = spark.createDataFrame([("b", 1.0, 5.0), ("a", 3.0, 5.0), ("a", None, 5.0), ("b", 5.0, 5.0), (None, 7.0, 5.0)], "c string, x double, k double")
    fitted = preprocess.fit_columns(train, ["x", "k"], ["c"])
    assert fitted.modes["c"] == "a"  # tie goes to the smallest
    assert fitted.medians["x"] == 4.0 and fitted.deviations["k"] == 1.0
    assert fitted.feature_names == ["numeric__x", "numeric__k", "categorical__c_a", "categorical__c_b"]
    new = spark.createDataFrame([("z", 4.0, 6.0), (None, None, 5.0)], "c string, x double, k double")
    unseen, missing = fitted.transform(new, []).collect()
    assert (unseen["categorical__c_a"], unseen["categorical__c_b"], unseen["numeric__k"]) == (0.0, 0.0, 1.0)
    assert (missing["categorical__c_a"], missing["numeric__x"]) == (1.0, 0.0)


def test_missing_can_be_a_category(spark):
    train = spark.createDataFrame([("b",), (None,)], "c string")
    fitted = preprocess.fit_columns(train, [], ["c"], missing_category=True)
    assert fitted.feature_names == ["categorical__c_b", "categorical__c_(missing)"]
    assert [tuple(r) for r in fitted.transform(train, []).collect()] == [(1.0, 0.0), (0.0, 1.0)]


def test_callers_may_refuse_identifiers(spark):
    with pytest.raises(ValueError, match="identifier"):
        preprocess.fit_columns(spark.range(20).select(F.col("id").cast("string").alias("c")), [], ["c"], most_categories=5)


def test_many_categories_make_sparse_vectors(spark):
    train = spark.range(2500).select(F.col("id").cast("string").alias("c"), F.col("id").cast("double").alias("x"))
    fitted = preprocess.fit_columns(train, ["x"], ["c"])
    got = {r["c"]: r["features"] for r in fitted.vectors(train.union(spark.createDataFrame([("new", 1.0), (None, 2.0)], "c string, x double")), ["c"]).collect()}
    names = fitted.feature_names
    assert len(names) == 2501 and all(v.size == 2501 for v in got.values())
    assert got["77"][names.index("categorical__c_77")] == 1.0 and sum(got["77"].toArray()[1:]) == 1.0
    assert sum(got["new"].toArray()[1:]) == 0.0 and sum(got[None].toArray()[1:]) == 1.0  # null takes the mode


def test_vectors_are_the_transformed_columns(spark):
    train = spark.createDataFrame([("b", 1.0), (None, 3.0), ("a", None)], "c string, x double")
    for missing in (True, False):
        fitted = preprocess.fit_columns(train, ["x"], ["c"], missing_category=missing)
        dense = sorted(tuple(float(v) for v in r) for r in fitted.transform(train, []).collect())
        assert sorted(tuple(r["features"].toArray()) for r in fitted.vectors(train, []).collect()) == dense


def test_rows_without_label_or_key_are_on_neither_side(spark):
    rows = [(n, n % 2) for n in range(40)] + [(100, None), (None, 1), (None, None), (101, 7)]
    split = preprocess.stratified_split(spark.createDataFrame(rows, "key long, y int"), "y", "key")
    assert split.where("split IS NULL").count() == 4 and split.where("split = 'validation'").count() == 8


def test_weights_balance_the_classes(spark):
    weighted = preprocess.add_class_weights(labelled(spark, 100, 10), "y")
    sums = {r["y"]: r["s"] for r in weighted.groupBy("y").agg(F.sum("weight").alias("s")).collect()}
    assert sums == {0: pytest.approx(50.0), 1: pytest.approx(50.0)}


def test_longer_prefixes_are_counted_only_where_many_rows_share_one(spark, monkeypatch):
    rows = labelled(spark, 3000, 700).localCheckpoint()
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup

    def split(name, few):
        monkeypatch.setattr(preprocess, "FEW_TO_ORDER", few)
        spark.sparkContext.setJobGroup(name, name)
        found = preprocess.stratified_split(rows, "y", "key")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return {r["key"] for r in found.where("split = 'validation'").collect()}, len(jobs(name))

    (few, short), (many, long) = split("split-short", 10_000), split("split-long", 0)
    assert few == many and short < long
    ranked = rows.selectExpr("key", "row_number() OVER (PARTITION BY y ORDER BY md5(concat('42:', key))) AS n", "count(*) OVER (PARTITION BY y) AS of")
    assert few == {r["key"] for r in ranked.where("n <= round(of * 0.2)").collect()}
