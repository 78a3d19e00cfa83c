"""Transactions: events stand for transactions, customer for customers.

Some values are nulled by rule so that the imputations have work to do.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from bindings.common import rounded, table
from sparquill.operators import clean, features, model, profile, split, stats, trees
from sparquill.session import work_path
from sparquill.sources import stores, writers


def transactions(spark, sf):
    e = table(spark, sf, "events")
    i = F.col("event_id")
    seconds = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).cast("double")
    return e.select(
        F.concat(F.lit("T"), i).alias("trans_num"),
        F.col("user_id").cast("string").alias("cc_num"),
        F.col("ts").alias("trans_date_trans_time"),
        F.when(i % 5 != 0, seconds - 220924800.0).alias("unix_time"),
        F.when(i % 11 != 0, F.concat(F.lit("Fraud_"), F.get_json_object("props", "$.k"))).alias("merchant"),
        F.when(i % 7 != 0, F.upper("event_type")).alias("category"),
        F.col("value").alias("amt"),
        (F.col("value") / 8).alias("merch_lat"),
        (F.col("user_id") - 100.0).alias("merch_long"),
    )


def labels(spark, sf):
    e = table(spark, sf, "events")
    return e.select(
        F.concat(F.lit("T"), F.col("event_id")).alias("trans_num"),
        F.when(F.col("event_id") % 97 != 0, (F.col("event_type") == "error").cast("int")).alias("is_fraud"),
    )


def customers(spark, sf):
    c = table(spark, sf, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("cc_num"),
        F.col("c_name").alias("last"),
        F.col("c_nationkey").cast("string").alias("state"),
        F.col("c_acctbal").alias("lat"),
        F.col("c_mktsegment").alias("job"),
    )


def _joined(spark, sf):
    return clean.join_sources(transactions(spark, sf), labels(spark, sf), customers(spark, sf))


def _cleaned(spark, sf):
    return clean.clean_transactions(_joined(spark, sf), sort=False)


def join_sources(spark, sf):
    return rounded(_joined(spark, sf))


def clean_transactions(spark, sf):
    return rounded(clean.clean_transactions(_joined(spark, sf)))


def impute_unix_time(spark, sf):
    t = clean.impute_unix_time(transactions(spark, sf))
    return rounded(t.select("trans_num", "unix_time", "unix_time_imputed"), 3)


def impute_category(spark, sf):
    return clean.impute_category(transactions(spark, sf)).select("trans_num", "merchant", "category")


def date_range(spark, sf):
    t = clean.date_range(transactions(spark, sf), start="2024-01-05", end="2024-01-20 12:00:00")
    return t.select("trans_num", "trans_date_trans_time")


def date_range_whole_day(spark, sf):
    t = clean.date_range(transactions(spark, sf), start="2024-01-05", end="2024-01-20", end_inclusive_day=True)
    return t.select("trans_num", "trans_date_trans_time")


def date_bounds(spark, sf):
    return clean.date_bounds(transactions(spark, sf))


def validate_input(spark, sf):
    i = F.col("event_id")
    raw = table(spark, sf, "events").select(
        i.alias("event_id"),
        F.when(i % 17 == 0, "not a time").otherwise(F.col("ts").cast("string")).alias("trans_date_trans_time"),
        F.col("user_id").cast("string").alias("cc_num"),
        F.lit(None).cast("string").alias("unix_time"),
        F.lit("m").alias("merchant"),
        F.col("event_type").alias("category"),
        F.when(i % 19 == 0, F.lit("abc")).when(i % 23 == 0, None).otherwise(F.col("value").cast("string")).alias("amt"),
        F.lit("1.5").alias("merch_lat"),
        F.lit("2.5").alias("merch_long"),
    )
    out = clean.validate_input(raw, 300.0)
    return out.select("event_id", "problem", "valid", "outlier")


def _labelled(spark, sf):
    return transactions(spark, sf).join(labels(spark, sf).filter("is_fraud is not null"), "trans_num")


def rate_by_hour(spark, sf):
    timed = features.time_features(_cleaned(spark, sf))
    return rounded(profile.rate_by(timed, F.col("hour_of_day"), "is_fraud", "hour"))


def _rate(expr, name):
    def run(spark, sf):
        return rounded(profile.rate_by(_labelled(spark, sf), expr(F.col("trans_date_trans_time")), "is_fraud", name))

    return run


def rate_by_category(spark, sf):
    out = profile.rate_by(_cleaned(spark, sf), F.col("category"), "is_fraud", "category")
    return rounded(out.orderBy(F.col("positives").desc(), "category"))


def chi_square(spark, sf):
    t = _labelled(spark, sf)
    return rounded(stats.chi_square(t, F.weekday("trans_date_trans_time"), "is_fraud"), 4)


def chi_square_hour(spark, sf):
    t = _labelled(spark, sf)
    return rounded(stats.chi_square(t, F.hour("trans_date_trans_time"), "is_fraud").select("statistic", "dof"), 4)


def chi_square_two_by_two(spark, sf):
    t = _labelled(spark, sf)
    return rounded(stats.chi_square(t, F.hour("trans_date_trans_time") < 12, "is_fraud").select("statistic", "dof"), 4)


def chi_square_expected(spark, sf):
    t = _labelled(spark, sf)
    return rounded(stats.expected_counts(t, F.hour("trans_date_trans_time"), "is_fraud"), 4)


def ks_two_sample(spark, sf):
    return rounded(stats.ks_two_sample(_labelled(spark, sf), "amt", "is_fraud"))


def describe_by_label(spark, sf):
    return rounded(profile.describe_by(_labelled(spark, sf), "amt", ["is_fraud"]), 5)


def describe_features(spark, sf):
    timed = features.time_features(transactions(spark, sf))
    return rounded(profile.describe(timed, ["amt", "merch_lat", "merch_long", "hour_sin"]), 5)


def density_histogram(spark, sf):
    return rounded(profile.density_histogram(_labelled(spark, sf), "amt", ["is_fraud"], 500))


def time_since_prev(spark, sf):
    out = stats.time_since_prev(transactions(spark, sf), "cc_num", "trans_date_trans_time", "trans_num")
    return rounded(out.select("trans_num", "cc_num", "minutes_since_prev"))


def _intervals(spark, sf):
    return stats.time_since_prev(_labelled(spark, sf), "cc_num", "trans_date_trans_time", "trans_num")


def interval_by_label(spark, sf):
    return rounded(stats.mean_by(_intervals(spark, sf), "minutes_since_prev", "is_fraud"), 4)


def interval_ks(spark, sf):
    return rounded(stats.ks_two_sample(_intervals(spark, sf), "minutes_since_prev", "is_fraud"))


def _orders(spark, sf):
    o = table(spark, sf, "orders")
    return o.withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority"))).withColumn(
        "is_fraud", (F.col("o_orderstatus") == "F").cast("bigint")
    )


def profile_table(spark, sf):
    return profile.profile_table(_orders(spark, sf), "is_fraud", "o_custkey")


def profile_completeness(spark, sf):
    return rounded(profile.profile_completeness(_orders(spark, sf)))


def profile_columns(spark, sf):
    return rounded(profile.profile_columns(_orders(spark, sf)), 4)


def profile_outliers(spark, sf):
    return profile.profile_outliers(_orders(spark, sf), 1.5)


def _split(spark, sf):
    return split.time_split(_orders(spark, sf), "o_orderdate", "o_orderkey", 0.2)


def time_split(spark, sf):
    return _split(spark, sf).select("o_orderkey", "o_orderdate", "split")


def _loose_transactions(spark, sf):
    """Transactions with their string key, every ninth without a time."""
    t = transactions(spark, sf)
    return t.withColumn("trans_date_trans_time", F.when(_event_number() % 9 != 0, F.col("trans_date_trans_time")))


def time_split_transactions(spark, sf):
    out = split.time_split(_loose_transactions(spark, sf), "trans_date_trans_time", "trans_num", 0.1)
    return out.select("trans_num", "split")


def time_folds_transactions(spark, sf):
    return split.time_folds(_loose_transactions(spark, sf), "trans_date_trans_time", "trans_num", 4).select("trans_num", "segment")


def time_split_range(spark, sf):
    out = split.time_split(_orders(spark, sf), "o_orderdate", "o_orderkey", 0.33, "1996-03-01", "1998-06-30")
    return out.select("o_orderkey", "o_orderdate", "split")


def stratified_split(spark, sf):
    return split.stratified_split(_orders(spark, sf), "o_orderstatus", "o_orderkey").select("o_orderkey", "split")


def time_folds(spark, sf):
    return split.time_folds(_orders(spark, sf), "o_orderdate", "o_orderkey", 4).select("o_orderkey", "segment")


def split_profile(spark, sf):
    return rounded(profile.split_profile(_split(spark, sf), "split", "is_fraud"))


def sink_roundtrip(spark, sf):
    path = work_path(spark, "cleaned")
    writers.write_parquet(_cleaned(spark, sf), path)
    return rounded(spark.read.parquet(path).select("trans_num", "merchant", "category", "amt", "is_fraud"))


def sink_split(spark, sf):
    path = work_path(spark, "split")
    writers.write_split(_split(spark, sf), path)
    back = spark.read.parquet(path)
    return back.groupBy("split").agg(F.count("*").alias("n"), F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))


def time_features(spark, sf):
    out = features.time_features(transactions(spark, sf))
    return rounded(out.select("trans_num", "hour_of_day", "day_of_week", "month", *features.NUMERIC[3:]))


def standard_scale(spark, sf):
    t = transactions(spark, sf)
    cols = ["amt", "merch_lat", "merch_long"]
    scaler = features.fit_scaler(t.filter(F.col("trans_date_trans_time") < F.lit("2024-01-25").cast("timestamp_ntz")), cols)
    return rounded(features.scale(t, scaler).select("trans_num", *[f"{c}_scaled" for c in cols]), 5)


def _event_number():
    return F.substring("trans_num", 2, 18).cast("bigint")


def target_encode(spark, sf):
    t = _labelled(spark, sf)
    t = clean.impute_category(t)
    out = features.cross_fit_encode(t, ["category", "merchant"], "is_fraud", _event_number() % 5, "trans_num")
    return rounded(out.select("trans_num", "category_encoded", "merchant_encoded"), 5)


def target_encode_test(spark, sf):
    t = clean.impute_category(_labelled(spark, sf))
    cut = F.lit("2024-01-25").cast("timestamp_ntz")
    train, test = t.filter(F.col("trans_date_trans_time") < cut), t.filter(F.col("trans_date_trans_time") >= cut)
    enc = features.fit_encodings(train, ["category", "merchant"], "is_fraud")
    out = features.apply_encodings(test, enc, ["category", "merchant"])
    return rounded(out.select("trans_num", "category_encoded", "merchant_encoded"), 5)


def feature_vector(spark, sf):
    t = features.time_features(transactions(spark, sf))
    cols = ["amt", "merch_lat", "merch_long", "hour_sin", "hour_cos"]
    v = features.feature_vector(t, cols).select("trans_num", vector_to_array("features").alias("v"))
    return rounded(v.select("trans_num", *[F.col("v")[i].alias(f"f{i}") for i in range(len(cols))]))


def _scored(spark, sf):
    return _labelled(spark, sf).withColumn("score", F.col("amt") / 500)


def pr_curve(spark, sf):
    return rounded(stats.pr_curve(_scored(spark, sf), "score", "is_fraud"))


def best_threshold(spark, sf):
    return rounded(stats.best_threshold(_scored(spark, sf), "score", "is_fraud", 0.1, 0.3))


def metric_alert(spark, sf):
    s = _scored(spark, sf).withColumn("prediction", F.col("score") >= 0.1)
    return rounded(stats.metric_alert(s, "prediction", "is_fraud"))


def preview(spark, sf):
    t = transactions(spark, sf)
    return split.preview(t, ["trans_date_trans_time", "trans_num"], 5, "merchant", 8).select("trans_num", "merchant")


# ---- models -----------------------------------------------------------------------------------


def _model_data(spark, sf):
    """The label follows the amount, with every tenth row turned round."""
    t = clean.impute_category(transactions(spark, sf))
    n = _event_number()
    big = (F.col("amt") > 60).cast("int")
    t = t.withColumn("is_fraud", F.when(n % 10 == 0, 1 - big).otherwise(big))
    cut = F.lit("2024-01-25").cast("timestamp_ntz")
    return t.filter(F.col("trans_date_trans_time") < cut), t.filter(F.col("trans_date_trans_time") >= cut)


def _train(kind, **params):
    def run(spark, sf):
        train, test = _model_data(spark, sf)
        p = model.train(train, test, kind, **params)
        scored = model.score(test, p)
        hits = F.count_if(F.col("prediction") & (F.col("is_fraud") == 1))
        out = scored.agg(
            F.count("*").alias("n"), (hits / F.count_if("prediction") >= 0.3).alias("precise"), (hits / F.count_if(F.col("is_fraud") == 1) >= 0.6).alias("complete"),
            *[F.bool_and(c).alias(name) for c, name in zip(checks(p), ("consistent", "in_range"))],
        )
        return out.withColumn("kind", F.lit(kind))

    return run


#: Features, label and settings of the trees that SQL grows too; small nodes are small enough for all ways of growing to take part.
TREE = dict(features=["l_quantity", "l_extendedprice", "l_discount", "l_tax"], trees=3, seed=7, max_depth=3)


def extra_tree_nodes(spark, sf):
    """Every node of a few shallow extra trees: they must be the same on any partitioning."""
    lines = table(spark, sf, "lineitem").select(*TREE["features"], (F.col("l_returnflag") == "R").cast("int").alias("y"))
    forest = trees.fit(lines, label="y", local_rows=3_000, **TREE)
    return forest.nodes().select("tree", "path", "feature", F.round("value", 9).alias("value"), "n", "pos")


def checks(package):
    """What every decision must satisfy, whatever the model has learned."""
    p = F.col("probability")
    return [(F.col("prediction") == (p >= package["threshold"])).alias("consistent"), p.between(0, 1).alias("in_range")]


def _package(spark, sf):
    train, test = _model_data(spark, sf)
    return model.train(train, test, "bagging"), test


def score_batch(spark, sf):
    package, test = _package(spark, sf)
    path = work_path(spark, "history")
    stores.append_history(model.history_rows(model.score(test, package)), path)
    return stores.read_history(spark, path).select("input.cc_num", "model", *checks(package))


def model_registry(spark, sf):
    package, test = _package(spark, sf)
    registry = stores.Registry(spark, work_path(spark, "models"))
    for version in ("bagging_1", "bagging_2"):
        registry.save(version, package["model"], package["scaler"], package["encodings"], package["threshold"], package["stats"])
    loaded = registry.load(registry.list()[-1])
    a = model.score(test, package).select("trans_num", F.col("probability").alias("before"))
    b = model.score(test, loaded).select("trans_num", "model", F.col("probability").alias("after"))
    return a.join(b, "trans_num").groupBy("model").agg(
        F.count("*").alias("n"), F.count_if(F.col("before") != F.col("after")).alias("changed")
    )


QUERIES = {
    f.__name__: f
    for f in (
        join_sources, clean_transactions, impute_unix_time, impute_category, date_range, date_range_whole_day, date_bounds,
        validate_input, rate_by_hour, rate_by_category, chi_square, chi_square_hour, chi_square_two_by_two,
        chi_square_expected, ks_two_sample, describe_by_label, describe_features, density_histogram, time_since_prev,
        interval_by_label, interval_ks, profile_table, profile_completeness, profile_columns, profile_outliers, time_split,
        time_split_range, time_split_transactions, time_folds_transactions, stratified_split, time_folds, split_profile, sink_roundtrip, sink_split, time_features,
        standard_scale, target_encode, target_encode_test, feature_vector, pr_curve, best_threshold, metric_alert, preview,
        score_batch, model_registry, extra_tree_nodes,
    )
}
QUERIES["rate_by_weekday"] = _rate(F.weekday, "weekday")
QUERIES["rate_by_month"] = _rate(F.month, "month")
QUERIES["train_forest"] = _train("forest")
QUERIES["train_bagging"] = _train("bagging")
QUERIES["train_extra"] = _train("extra")
QUERIES["train_mlp"] = _train("mlp")

# ---- the same in SQL ----------------------------------------------------------------------------

_T = """
WITH txn AS (
  SELECT 'T' || event_id AS trans_num, user_id::VARCHAR AS cc_num, ts AS trans_date_trans_time,
    CASE WHEN event_id % 5 <> 0 THEN floor(epoch_us(ts) / 1e6::DOUBLE)::DOUBLE - 220924800.0::DOUBLE END AS unix_time,
    CASE WHEN event_id % 11 <> 0 THEN 'Fraud_' || (props->>'$.k') END AS merchant,
    CASE WHEN event_id % 7 <> 0 THEN upper(event_type) END AS category,
    value AS amt, value / 8 AS merch_lat, user_id - 100.0::DOUBLE AS merch_long, event_id
  FROM events),
lab AS (SELECT 'T' || event_id AS trans_num,
    CASE WHEN event_id % 97 <> 0 THEN (event_type = 'error')::INTEGER END AS is_fraud FROM events),
cust AS (SELECT c_custkey::VARCHAR AS cc_num, c_name AS last, c_nationkey::VARCHAR AS state, c_acctbal AS lat,
    c_mktsegment AS job FROM customer),
lt AS (SELECT txn.*, is_fraud FROM txn JOIN lab USING (trans_num) WHERE is_fraud IS NOT NULL)
"""


def _modes(src: str) -> str:
    return f""",
modes AS (SELECT merchant, category AS mode FROM {src} WHERE merchant IS NOT NULL AND category IS NOT NULL
  GROUP BY merchant, category QUALIFY row_number() OVER (PARTITION BY merchant ORDER BY count(*) DESC, category) = 1),
imp AS (SELECT s.* EXCLUDE (merchant, category), coalesce(s.merchant, 'unknown') AS merchant,
    coalesce(s.category, mode, 'unknown') AS category FROM {src} s LEFT JOIN modes m ON s.merchant = m.merchant)
"""


_CLEAN = _T + """,
j AS (SELECT trans_date_trans_time, cc_num, lower(merchant) AS merchant, lower(category) AS category, amt, lower(last) AS last,
   state, lat, lower(job) AS job, lower(trans_num) AS trans_num, coalesce(unix_time, epoch_us(trans_date_trans_time) / 1e6::DOUBLE) AS unix_time,
   merch_lat, merch_long, is_fraud FROM lt JOIN cust USING (cc_num))""" + _modes("j")


def _rates(key: str, name: str, src: str = "lt") -> str:
    return f"""SELECT {key} AS {name}, count(*) AS n, sum(is_fraud)::BIGINT AS positives,
      round(sum(is_fraud)::DOUBLE / count(*) * 100, 6) AS percent, (count(*) - sum(is_fraud))::BIGINT AS negatives
      FROM {src} GROUP BY 1"""


def _chi(key: str) -> str:
    return _T + f""",
cells AS (SELECT {key} AS k, count(*)::DOUBLE AS n, sum(is_fraud)::DOUBLE AS n1 FROM lt GROUP BY 1),
tot AS (SELECT sum(n1) / sum(n) AS p FROM cells),
obs AS (SELECT n1 AS o, n * p AS e FROM cells, tot UNION ALL SELECT n - n1, n * (1 - p) FROM cells, tot),
res AS (SELECT sum((o - e) * (o - e) / e) AS x, sum(pow(greatest(abs(o - e) - 0.5, 0), 2) / e) AS yates,
   (SELECT count(*) - 1 FROM cells) AS dof FROM obs)
"""


_KS = """,
v AS (SELECT {v} AS v, is_fraud FROM {src} WHERE {v} IS NOT NULL),
d AS (SELECT v, sum(is_fraud) AS a, count(*) - sum(is_fraud) AS b FROM v GROUP BY 1),
c AS (SELECT sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER () AS ta, sum(b) OVER () AS tb FROM d
  WINDOW w AS (ORDER BY v ROWS UNBOUNDED PRECEDING)),
k AS (SELECT max(abs(ca::DOUBLE / ta - cb::DOUBLE / tb)) AS statistic, max(ta)::BIGINT AS n1, max(tb)::BIGINT AS n0 FROM c),
x AS (SELECT *, statistic * sqrt(n1::DOUBLE * n0 / (n1 + n0)) AS x FROM k)
SELECT round(statistic, 6) AS statistic, n1, n0, round(CASE WHEN x < 0.2 THEN 1 ELSE greatest(0, least(1,
  (SELECT sum((CASE WHEN i % 2 = 1 THEN 2.0 ELSE -2.0 END)::DOUBLE * exp(-2.0::DOUBLE * i * i * x.x * x.x)) FROM range(1, 101) r(i))
  )) END::DOUBLE, 6) AS p_value FROM x"""

_GAP = """, gaps AS (SELECT {src}.*, (epoch_us(trans_date_trans_time) - lag(epoch_us(trans_date_trans_time)) OVER
   (PARTITION BY cc_num ORDER BY trans_date_trans_time, trans_num)) / 6e7::DOUBLE AS m FROM {src})
"""

_ORD = """WITH o AS (SELECT * REPLACE (CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS o_orderpriority),
   (o_orderstatus = 'F')::BIGINT AS is_fraud FROM orders)
"""
_SPLIT = _ORD + """, s AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey) <=
   floor(count(*) OVER () * (1 - 0.2::DOUBLE)) THEN 'train' ELSE 'test' END AS split FROM o)
"""
_NUMS = ["o_orderkey", "o_custkey", "o_totalprice", "is_fraud"]
_ALL = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "is_fraud"]
_CIRCLE = ", ".join(
    f"round({fn}(2 * pi() * {c} / {p}), 6) + 0.0::DOUBLE AS {n}_{fn}"
    for n, c, p in (("hour", "hour(ts)", 24), ("day", "(isodow(ts) - 1)", 7), ("month", "month(ts)", 12))
    for fn in ("sin", "cos")
)


def _describe(value: str, src: str, by: str) -> str:
    return f"""SELECT {by}, count({value}) AS n, round(avg({value}), 5) AS mean, round(stddev_samp({value}), 5) AS std,
      round(min({value}), 5) + 0.0::DOUBLE AS min, round(max({value}), 5) AS max,
      round(quantile_cont({value}, 0.25), 5) + 0.0::DOUBLE AS q25,
      round(quantile_cont({value}, 0.5), 5) + 0.0::DOUBLE AS q50, round(quantile_cont({value}, 0.75), 5) + 0.0::DOUBLE AS q75
      FROM {src} GROUP BY 1"""


_ENC = """CASE WHEN n > 0 AND (s / n) * (1 - s / n) + n * gp * (1 - gp) > 0 THEN
    (n * gp * (1 - gp)) / ((s / n) * (1 - s / n) + n * gp * (1 - gp)) * (s / n)
    + (1 - (n * gp * (1 - gp)) / ((s / n) * (1 - s / n) + n * gp * (1 - gp))) * gp ELSE gp END"""


def _fold(c: str) -> str:
    return f""",
cf_{c} AS (SELECT {c} AS k, f, count(*)::DOUBLE AS nf, sum(is_fraud)::DOUBLE AS sf FROM ff GROUP BY ALL),
co_{c} AS (SELECT k, f, sum(nf) OVER (PARTITION BY k) - nf AS n, sum(sf) OVER (PARTITION BY k) - sf AS s, gp
  FROM cf_{c} JOIN gl USING (f)),
ce_{c} AS (SELECT k, f, {_ENC} AS e FROM co_{c})
"""


_WRAP = "18446744073709551616::UHUGEINT"


def _mix(x: str) -> str:
    """The hash of the trees, modulo 2^64."""
    a = f"list_transform([{x}], lambda v: ((xor(v, v >> 30)::UHUGEINT * {trees.MIX_1}::UHUGEINT) % {_WRAP})::UBIGINT)"
    b = f"list_transform({a}, lambda v: ((xor(v, v >> 27)::UHUGEINT * {trees.MIX_2}::UHUGEINT) % {_WRAP})::UBIGINT)"
    return f"list_transform({b}, lambda v: xor(v, v >> 31))[1]"


def _plus(x: str, y: str) -> str:
    return f"(({x}::UHUGEINT + ({y})::UHUGEINT) % {_WRAP})::UBIGINT"


def _tree_sql(features: list[str], trees: int, seed: int, max_depth: int, k: int = 2) -> str:
    """Level by level: ranges, candidates, counts on the left, the purest split, rows moved to its sides."""
    gold = "11400714819323198485::UHUGEINT"
    root = _mix(_plus(f"({seed}::UHUGEINT * {gold}) % {_WRAP}", "tree"))
    ctes = [f"""r0 AS (SELECT tree, '' AS path, {root} AS state, [{', '.join(f'{c}::DOUBLE' for c in features)}] AS x, (l_returnflag = 'R')::INT AS y
      FROM lineitem, (SELECT unnest(range({trees})) AS tree))"""]
    for i in range(max_depth + 1):
        spread = ", ".join(f"min(x[{f}]) AS lo{f}, max(x[{f}]) AS hi{f}" for f in range(1, len(features) + 1))
        ctes.append(f"n{i} AS (SELECT tree, path, state, count(*) AS n, sum(y)::BIGINT AS pos, {spread} FROM r{i} GROUP BY ALL)")
        if i == max_depth:
            break
        each = " UNION ALL ".join(
            f"SELECT tree, path, n, pos, {f - 1} AS f, lo{f} AS lo, hi{f} AS hi, {_mix(_plus('state', f'{2 * f - 1}::UHUGEINT * {gold}'))} AS o, "
            f"({_mix(_plus('state', f'{2 * f}::UHUGEINT * {gold}'))} >> 11)::DOUBLE / 9007199254740992 AS u FROM n{i}" for f in range(1, len(features) + 1)
        )
        ctes += [
            f"d{i} AS ({each})",
            f"c{i} AS (SELECT *, CASE WHEN lo + u * (hi - lo) >= hi THEN lo ELSE lo + u * (hi - lo) END AS t FROM d{i} WHERE hi > lo AND pos BETWEEN 1 AND n - 1 "
            f"QUALIFY row_number() OVER (PARTITION BY tree, path ORDER BY o) <= {k})",
            f"""l{i} AS (SELECT c.tree, c.path, c.n::DOUBLE AS n, c.pos::DOUBLE AS pos, f, t, o, count(*) FILTER (x[f + 1] <= t)::DOUBLE AS nl, (sum(y) FILTER (x[f + 1] <= t))::DOUBLE AS pl
              FROM c{i} c JOIN r{i} r USING (tree, path) GROUP BY ALL)""",
            f"""s{i} AS (SELECT tree, path, f, t FROM l{i} QUALIFY row_number() OVER (PARTITION BY tree, path ORDER BY
              (pl * pl + (nl - pl) * (nl - pl)) / nl + ((pos - pl) * (pos - pl) + ((n - nl) - (pos - pl)) * ((n - nl) - (pos - pl))) / (n - nl) DESC, o) = 1)""",
            f"""m{i} AS (SELECT r.tree, r.path, r.state, x, y, x[f + 1] <= t AS goes FROM r{i} r JOIN s{i} USING (tree, path))""",
            f"""r{i + 1} AS (SELECT tree, path || CASE WHEN goes THEN 'L' ELSE 'R' END AS path, {_mix(_plus('state', 'CASE WHEN goes THEN 1 ELSE 2 END'))} AS state, x, y FROM m{i})""",
        ]
    out = [f"SELECT tree, path, coalesce(f, -1)::INT AS feature, round(CASE WHEN f IS NULL THEN pos / n ELSE t END, 9) AS value, n, pos FROM n{i} LEFT JOIN s{i} USING (tree, path)" for i in range(max_depth)]
    out.append(f"SELECT tree, path, -1, round(pos / n, 9), n, pos FROM n{max_depth}")
    return "WITH " + ",\n".join(ctes) + "\n" + " UNION ALL ".join(out)


_LATE = "FROM events WHERE ts >= TIMESTAMP '2024-01-25'"

SQL = {
    **{f"train_{k}": f"SELECT count(*) AS n, true AS precise, true AS complete, true AS consistent, true AS in_range, '{k}' AS kind {_LATE}" for k in model.KINDS},
    "extra_tree_nodes": _tree_sql(**TREE),
    "score_batch": f"SELECT user_id::VARCHAR AS cc_num, 'bagging' AS model, true AS consistent, true AS in_range {_LATE}",
    "model_registry": f"SELECT 'bagging_2' AS model, count(*) AS n, 0::BIGINT AS changed {_LATE}",
    "join_sources": _T + """SELECT trans_num, cc_num, trans_date_trans_time, unix_time, merchant, category, round(amt, 6) AS amt,
        round(merch_lat, 6) AS merch_lat, round(merch_long, 6) AS merch_long, is_fraud, last, state, round(lat, 6) AS lat, job
        FROM txn JOIN lab USING (trans_num) JOIN cust USING (cc_num)""",
    "clean_transactions": _CLEAN + """SELECT trans_date_trans_time, cc_num, merchant, category, round(amt, 6) AS amt, last, state,
        round(lat, 6) AS lat, job, trans_num, round(unix_time, 6) AS unix_time, round(merch_lat, 6) AS merch_lat,
        round(merch_long, 6) AS merch_long, is_fraud FROM imp""",
    "impute_unix_time": _T + """SELECT trans_num, round(coalesce(unix_time, epoch_us(trans_date_trans_time) / 1e6::DOUBLE), 3) AS unix_time,
        unix_time IS NULL AS unix_time_imputed FROM txn""",
    "impute_category": _T + _modes("txn") + "SELECT trans_num, merchant, category FROM imp",
    "date_range": _T + """SELECT trans_num, trans_date_trans_time FROM txn
        WHERE trans_date_trans_time BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20 12:00:00'""",
    "date_range_whole_day": _T + """SELECT trans_num, trans_date_trans_time FROM txn
        WHERE trans_date_trans_time >= TIMESTAMP '2024-01-05' AND trans_date_trans_time < TIMESTAMP '2024-01-21'""",
    "date_bounds": "SELECT min(ts) AS first_ts, max(ts) AS last_ts FROM events",
    "validate_input": """WITH r AS (SELECT event_id, event_id % 17 = 0 AS bad_ts, event_id % 19 = 0 OR event_id % 23 = 0 AS bad_amt, value FROM events)
        SELECT event_id, concat_ws(',', CASE WHEN bad_ts THEN 'trans_date_trans_time' END, CASE WHEN bad_amt THEN 'amt' END) AS problem,
          NOT bad_ts AND NOT bad_amt AS valid, NOT bad_amt AND value > 300 AS outlier FROM r""",
    "rate_by_hour": _CLEAN + _rates("hour(trans_date_trans_time)::INTEGER", "hour", "imp"),
    "rate_by_weekday": _T + _rates("(isodow(trans_date_trans_time) - 1)::INTEGER", "weekday"),
    "rate_by_month": _T + _rates("month(trans_date_trans_time)::INTEGER", "month"),
    "rate_by_category": _CLEAN + _rates("category", "category", "imp"),
    "chi_square": _chi("isodow(trans_date_trans_time)") + """SELECT round(x, 4) AS statistic, dof, round(p, 4) AS p_value, p < 0.05 AS significant
        FROM (SELECT *, exp(-x / 2) * (1 + x / 2 + x * x / 8) AS p FROM res)""",
    "chi_square_hour": _chi("hour(trans_date_trans_time)") + "SELECT round(x, 4) AS statistic, dof FROM res",
    "chi_square_two_by_two": _chi("hour(trans_date_trans_time) < 12") + "SELECT round(yates, 4) AS statistic, dof FROM res",
    "chi_square_expected": _T + """, cells AS (SELECT hour(trans_date_trans_time)::INTEGER AS key, count(*) AS n, sum(is_fraud)::BIGINT AS positives FROM lt GROUP BY 1)
        SELECT key, positives, n - positives AS negatives, round(n * p, 4) AS expected_positives, round(n * (1 - p), 4) AS expected_negatives
        FROM cells, (SELECT avg(is_fraud) AS p FROM lt)""",
    "ks_two_sample": _T + _KS.format(v="amt", src="lt"),
    "describe_by_label": _T + _describe("amt", "lt", "is_fraud"),
    "describe_features": _T + """, l AS (SELECT unnest(['amt', 'merch_lat', 'merch_long', 'hour_sin']) AS column_name,
          unnest([amt, merch_lat, merch_long, sin(2 * pi() * hour(trans_date_trans_time) / 24)]) AS v FROM txn)
        """ + _describe("v", "l", "column_name"),
    "density_histogram": _T + """, q AS (SELECT is_fraud, quantile_cont(amt, 0.99) AS lim FROM lt GROUP BY 1),
        b AS (SELECT is_fraud, least(floor(amt / (lim / 500)), 499)::INTEGER AS bin, lim, count(*) AS n FROM lt JOIN q USING (is_fraud)
          WHERE amt >= 0 AND amt <= lim GROUP BY ALL)
        SELECT is_fraud, bin, round(bin * (lim / 500), 6) AS bin_start, n,
          round(n / (sum(n) OVER (PARTITION BY is_fraud) * (lim / 500)), 6) AS density FROM b""",
    "time_since_prev": _T + _GAP.format(src="txn") + "SELECT trans_num, cc_num, round(m, 6) AS minutes_since_prev FROM gaps",
    "interval_by_label": _T + _GAP.format(src="lt") + """SELECT is_fraud, round(avg(m), 4) AS mean_minutes_since_prev, count(m) AS n
        FROM gaps GROUP BY 1""",
    "interval_ks": _T + _GAP.format(src="lt") + _KS.format(v="m", src="gaps"),
    "profile_table": _ORD + """SELECT count(*) AS row_count, 7::BIGINT AS column_count, sum(is_fraud)::BIGINT AS positives,
        count(DISTINCT o_custkey) AS unique_keys FROM o""",
    "profile_completeness": _ORD + """SELECT round((6 * count(*) + count(o_orderpriority))::DOUBLE / (7 * count(*)), 6) AS table_completeness,
        round(count(o_orderpriority)::DOUBLE / count(*), 6) AS row_completeness, round(6 / 7::DOUBLE, 6) AS column_completeness FROM o""",
    "profile_columns": _ORD + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, "
        + (f"round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std" if c in _NUMS else "NULL::DOUBLE, NULL::DOUBLE")
        + " FROM o"
        for c in _ALL
    ),
    "profile_outliers": _ORD + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (abs(({c} - m) / s) > 1.5) AS outliers_count "
        f"FROM o, (SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM o)"
        for c in _NUMS
    ),
    "time_split": _SPLIT + "SELECT o_orderkey, o_orderdate, split FROM s",
    "time_split_range": _ORD + """SELECT o_orderkey, o_orderdate, CASE WHEN row_number() OVER (ORDER BY o_orderdate, o_orderkey) <=
          floor(count(*) OVER () * (1 - 0.33::DOUBLE)) THEN 'train' ELSE 'test' END AS split
        FROM o WHERE o_orderdate BETWEEN TIMESTAMP '1996-03-01' AND TIMESTAMP '1998-06-30'""",
    "time_split_transactions": _T + """SELECT trans_num, CASE WHEN row_number() OVER (ORDER BY CASE WHEN event_id % 9 <> 0 THEN trans_date_trans_time END NULLS LAST, trans_num)
          <= floor(count(*) OVER () * (1 - 0.1::DOUBLE)) THEN 'train' ELSE 'test' END AS split FROM txn""",
    "time_folds_transactions": _T + """SELECT trans_num, ((r > c * 1 // 5)::INT + (r > c * 2 // 5)::INT + (r > c * 3 // 5)::INT + (r > c * 4 // 5)::INT) AS segment
        FROM (SELECT trans_num, row_number() OVER (ORDER BY CASE WHEN event_id % 9 <> 0 THEN trans_date_trans_time END NULLS LAST, trans_num) AS r, count(*) OVER () AS c FROM txn)""",
    "stratified_split": _ORD + """SELECT o_orderkey, CASE WHEN row_number() OVER (PARTITION BY o_orderstatus ORDER BY
          ('0x' || substr(md5('42-' || o_orderkey), 1, 15))::BIGINT, o_orderkey)
          <= floor(count(*) OVER (PARTITION BY o_orderstatus) * (1 - 0.2::DOUBLE)) THEN 'train' ELSE 'test' END AS split FROM o""",
    "time_folds": _ORD + """SELECT o_orderkey, ((r > c * 1 // 5)::INT + (r > c * 2 // 5)::INT + (r > c * 3 // 5)::INT + (r > c * 4 // 5)::INT) AS segment
        FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS r, count(*) OVER () AS c FROM o)""",
    "split_profile": _SPLIT + """SELECT split, is_fraud, count(*) AS n, sum(count(*)) OVER (PARTITION BY split)::BIGINT AS split_size,
        round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY split), 6) AS share, 6::BIGINT AS feature_count FROM s GROUP BY split, is_fraud""",
    "sink_roundtrip": _CLEAN + "SELECT trans_num, merchant, category, round(amt, 6) AS amt, is_fraud FROM imp",
    "sink_split": _SPLIT + """SELECT split, count(*) AS n, min(o_orderdate) AS "first", max(o_orderdate) AS "last" FROM s GROUP BY 1""",
    "time_features": f"""SELECT 'T' || event_id AS trans_num, hour(ts)::INTEGER AS hour_of_day, (isodow(ts) - 1)::INTEGER AS day_of_week,
        month(ts)::INTEGER AS month, {_CIRCLE} FROM events""",
    "standard_scale": _T + """SELECT trans_num, round((amt - a) / sa, 5) + 0.0::DOUBLE AS amt_scaled, round((merch_lat - b) / sb, 5) + 0.0::DOUBLE AS merch_lat_scaled,
        round((merch_long - c) / sc, 5) + 0.0::DOUBLE AS merch_long_scaled FROM txn, (SELECT avg(amt) AS a, stddev_pop(amt) AS sa, avg(merch_lat) AS b,
          stddev_pop(merch_lat) AS sb, avg(merch_long) AS c, stddev_pop(merch_long) AS sc FROM txn
          WHERE trans_date_trans_time < TIMESTAMP '2024-01-25')""",
    "target_encode": _T + _modes("lt") + """, ff AS (SELECT *, event_id % 5 AS f FROM imp),
        gf AS (SELECT f, count(*)::DOUBLE AS n, sum(is_fraud)::DOUBLE AS s FROM ff GROUP BY 1),
        gl AS (SELECT f, (sum(s) OVER () - s) / (sum(n) OVER () - n) AS gp FROM gf)""" + _fold("category") + _fold("merchant") + """
        SELECT trans_num, round(a.e, 5) AS category_encoded, round(b.e, 5) AS merchant_encoded FROM ff
        JOIN ce_category a ON a.k = category AND a.f = ff.f JOIN ce_merchant b ON b.k = merchant AND b.f = ff.f""",
    "target_encode_test": _T + _modes("lt") + f""", tr AS (SELECT * FROM imp WHERE trans_date_trans_time < TIMESTAMP '2024-01-25'),
        gl AS (SELECT avg(is_fraud) AS gp FROM tr),
        ca AS (SELECT category AS k, {_ENC} AS e FROM (SELECT category, count(*)::DOUBLE AS n, sum(is_fraud)::DOUBLE AS s FROM tr GROUP BY 1), gl),
        me AS (SELECT merchant AS k, {_ENC} AS e FROM (SELECT merchant, count(*)::DOUBLE AS n, sum(is_fraud)::DOUBLE AS s FROM tr GROUP BY 1), gl)
        SELECT trans_num, round(coalesce(ca.e, gp), 5) AS category_encoded, round(coalesce(me.e, gp), 5) AS merchant_encoded
        FROM imp CROSS JOIN gl LEFT JOIN ca ON ca.k = category LEFT JOIN me ON me.k = merchant
        WHERE trans_date_trans_time >= TIMESTAMP '2024-01-25'""",
    "feature_vector": """SELECT 'T' || event_id AS trans_num, round(value, 6) AS f0, round(value / 8, 6) AS f1, round(user_id - 100.0::DOUBLE, 6) AS f2,
        round(sin(2 * pi() * hour(ts) / 24), 6) + 0.0::DOUBLE AS f3, round(cos(2 * pi() * hour(ts) / 24), 6) + 0.0::DOUBLE AS f4 FROM events""",
    "pr_curve": _T + """, d AS (SELECT amt / 500 AS t, count(*) AS n, sum(is_fraud) AS p FROM lt GROUP BY 1),
        c AS (SELECT t, sum(n) OVER w AS n, (sum(p) OVER w)::DOUBLE AS p, sum(p) OVER () AS tp FROM d WINDOW w AS (ORDER BY t DESC)),
        pr AS (SELECT t, p / n AS pr, p / tp AS re FROM c)
        SELECT round(t, 6) AS threshold, round(pr, 6) AS precision, round(re, 6) AS recall, round(2 * pr * re / (pr + re + 1e-8::DOUBLE), 6) AS f1 FROM pr""",
    "best_threshold": _T + """, d AS (SELECT amt / 500 AS t, count(*) AS n, sum(is_fraud) AS p FROM lt GROUP BY 1),
        c AS (SELECT t, sum(n) OVER w AS n, (sum(p) OVER w)::DOUBLE AS p, sum(p) OVER () AS tp FROM d WINDOW w AS (ORDER BY t DESC)),
        pr AS (SELECT t, p / n AS pr, p / tp AS re, 2 * (p / n) * (p / tp) / (p / n + p / tp + 1e-8::DOUBLE) AS f FROM c)
        SELECT round(t, 6) AS threshold, round(pr, 6) AS precision, round(re, 6) AS recall, round(f, 6) AS f1 FROM pr
        WHERE pr >= 0.1 AND re >= 0.3 ORDER BY f DESC, t LIMIT 1""",
    "metric_alert": _T + """, s AS (SELECT amt / 500 >= 0.1 AS p, is_fraud = 1 AS y FROM lt),
        c AS (SELECT count(*) FILTER (p AND y) AS tp, count(*) FILTER (p AND NOT y) AS fp, count(*) FILTER (NOT p AND y) AS fn FROM s)
        SELECT tp, fp, fn, round(tp::DOUBLE / (tp + fp), 6) AS precision, round(tp::DOUBLE / (tp + fn), 6) AS recall,
          tp::DOUBLE / (tp + fp) < 0.35 OR tp::DOUBLE / (tp + fn) < 0.6 AS alert FROM c""",
    "preview": _T + "SELECT trans_num, substr(merchant, 1, 8) AS merchant FROM txn ORDER BY trans_date_trans_time, trans_num LIMIT 5",
}
