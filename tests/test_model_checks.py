"""The rules of predictions, counted for all models in one shuffle."""

from pyspark.sql import functions as F

from demandgrid.operators import contracts as Q


def stacked(spark, n, models):
    rows = spark.range(n).select("id", F.explode(F.array(*[F.lit(m) for m in models])).alias("model"))
    return rows.withColumn("prediction", F.col("id") % 7)


def checks(targets, made):
    return {r.model: r for r in Q.model_checks(targets, made).collect()}


def test_ids_of_all_models_take_one_shuffle_of_narrow_rows(spark):
    targets, made = spark.range(300), stacked(spark, 300, ["m", "n", "o"])
    plan = Q.model_checks(targets, made)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(id") == 1
    assert "Exchange hashpartitioning(model" not in plan


def test_null_ids_null_models_and_many_models(spark, monkeypatch):
    models = [f"m{k}" for k in range(40)]
    made = stacked(spark, 20, models).where("model != 'm7' or id % 2 = 0").unionByName(
        spark.sql("""
            SELECT CAST(NULL AS BIGINT) id, 'm3' model, 1L prediction UNION ALL
            SELECT NULL, 'm3', 2L UNION ALL SELECT 5L, 'm39', NULL UNION ALL
            SELECT 99L, 'm16', -1L UNION ALL SELECT 3L, NULL, 1L""")
    )
    targets = spark.range(20).unionAll(spark.sql("SELECT CAST(NULL AS BIGINT)")).unionAll(spark.range(1))
    found = checks(targets, made)
    assert set(found) == {*models, None}

    def told(m):
        r = found[m]
        return (r.row_count, r.numeric, r.finite, r.non_negative, r.prediction_ids_unique, r.no_extra_ids, r.no_missing_ids)

    assert told("m0") == (2, 0, 0, 0, 0, 0, 0)
    assert told("m3") == (0, 0, 0, 0, 1, 1, 0)  # two rows without an id
    assert told("m7") == (12, 0, 0, 0, 0, 0, 10)
    assert told("m16") == (1, 0, 0, 1, 0, 1, 0)
    assert told("m39") == (1, 1, 0, 0, 1, 0, 0)
    assert told(None) == (21, 0, 0, 0, 0, 0, 19)
    monkeypatch.setattr(Q, "MODELS_ABREAST", 3)
    assert {m: tuple(r) for m, r in checks(targets, made).items()} == {m: tuple(r) for m, r in found.items()}
    assert checks(targets, made.limit(0)) == {}
