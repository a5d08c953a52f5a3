"""Dataset preparation, metrics, oversampling and models."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from tidemark import schemas as S
from tidemark.plans import dataset as D
from tidemark.plans import evaluate as V
from tidemark.plans import features as P
from tidemark.plans import metrics as M
from tidemark.plans import models as L
from tidemark.plans import oversample as O
from tidemark.plans import similar as A
from tidemark.queries.features import ENRICHED, SQL
from tidemark.queries.registry import query
from tidemark.session import materialize, shared_folder
from tidemark.sources.tables import write_metrics
from tidemark.streaming import scoring as R

ID = "transaction_id"


def feature_table(fx):
    """Written once, as a feature job would, because preparation reads it several times."""
    return materialize(_features(fx))


def _features(fx):
    return P.all_features(fx.transactions(), fx.merchants(), fx.payment_methods())


def rounded(df, digits: int, *names: str):
    return df.withColumns({n: F.round(n, digits) for n in names})


# ---------------------------------------------------------------------------- classes, scaling

COUNTS = """select count(*) filter (is_fraudulent = 0) as n_normal,
  count(*) filter (is_fraudulent = 1) as n_fraud from tx"""


@query(
    "a01_class_ratio",
    f"""select n_normal, n_fraud,
          case when n_fraud > 0 then n_normal / n_fraud::double else 1.0::double end as ratio
        from ({COUNTS})""",
    "tx",
)
def _(fx):
    return D.class_counts(fx.transactions())


@query(
    "a02_class_weights",
    f"""select transaction_id,
          case when is_fraudulent = 1 then n_normal / n_fraud::double else 1.0::double end
            as boosted_weight,
          (n_normal + n_fraud) / (2 * case when is_fraudulent = 1 then n_fraud else n_normal end)
            ::double as balanced_weight
        from tx, ({COUNTS})""",
    "tx",
)
def _(fx):
    rows = fx.transactions()
    counts = D.class_counts(rows).first()
    return rows.select(
        ID,
        D.weight_column(counts, balanced=False).alias("boosted_weight"),
        D.weight_column(counts, balanced=True).alias("balanced_weight"),
    )


HASH = "('0x' || substr(md5(cast(transaction_id as varchar)), 1, 8))::bigint % 100 < 20"


@query(
    "a03_standard_scaling",
    f"""select transaction_id, round((x - mx) / sx, 6) as x, round((y - my) / sy, 6) as y from
        (select transaction_id, cast(usd as double) as x, cast(merchant_id as double) as y from tx),
        (select avg(usd::double) as mx, stddev_pop(usd::double) as sx,
                avg(merchant_id::double) as my, stddev_pop(merchant_id::double) as sy
         from tx where not ({HASH}))""",
    "tx",
)
def _(fx):
    rows = fx.transactions().select(
        ID,
        F.col("transaction_amount_usd").cast("double").alias("x"),
        F.col("merchant_id").cast("double").alias("y"),
    )
    scaling = D.fit_scaling(rows.filter(~D.hash_split_flag()), ["x", "y"])
    return rounded(scaling.apply(rows), 6, "x", "y")


# ------------------------------------------------------------------------------------- splits


@query("l01_hash_split", f"select transaction_id, {HASH} as is_test from tx", "tx")
def _(fx):
    return fx.transactions().select(ID, D.hash_split_flag().alias("is_test"))


@query(
    "l01_stratified_split",
    """select transaction_id, is_fraudulent,
         row_number() over (partition by is_fraudulent
           order by md5(cast(transaction_id as varchar)), transaction_id)
         <= floor(count(*) over (partition by is_fraudulent) * 0.2 + 0.5) as is_test from tx""",
    "tx",
)
def _(fx):
    rows = fx.transactions().select(ID, "is_fraudulent")
    return D.stratified_split_flag(rows)


def _prepared_sql(columns: str = "transaction_id, is_fraudulent, is_test", absent: str = "null") -> str:
    """The encoded inputs, scaled by the mean and deviation of the training rows."""
    inputs = {
        "transaction_amount_usd": "cast(usd as double)",
        "transaction_channel": "case channel when 'Online' then 1.0 when 'Local' then 0.0 end",
    }
    for name, sql in SQL.items():
        value = f"cast({sql} as double)"
        if name == "user_stddev_amount_24h":
            frame = "over (partition by user_id order by t range between 86400 preceding and current row)"
            value = f"stddev_samp(cast(usd as double)) {frame}"
        inputs[name] = f"coalesce({value}, {D.FILLS[name]})" if name in D.FILLS else value
    for c in S.MERCHANT_CATEGORIES:
        inputs[f"merchant_category_{c}"] = f"case when category = '{c}' then 1.0 else 0.0 end"
    encoded = ",\n".join(f'cast({sql} as double) as "{n}"' for n, sql in inputs.items())
    fitted = ", ".join(
        f'avg("{n}") filter (not is_test) over () as "m_{n}",'
        f' stddev_pop("{n}") filter (not is_test) over () as "s_{n}"'
        for n in inputs
    )
    scaled = ", ".join(
        f'coalesce(round(("{n}" - "m_{n}") / case when "s_{n}" = 0 then 1 else "s_{n}" end, 4),'
        f' {absent}) as "{n}"'
        for n in inputs
    )
    return f"""+, encoded as (
        select transaction_id, is_fraudulent, {HASH} as is_test, {encoded} from {ENRICHED}),
      fitted as (select *, {fitted} from encoded)
      select {columns}, {scaled} from fitted""".replace("+,", "+")


@query("l02_prepare_dataset", _prepared_sql(), "txm pm")
def _(fx):
    prepared = D.prepare(feature_table(fx))
    rows = prepared.train.withColumn("is_test", F.lit(False)).unionByName(
        prepared.test.withColumn("is_test", F.lit(True))
    )
    return rounded(rows, 4, *prepared.inputs)


# ------------------------------------------------------------------------------------- metrics

CURVE = """points as (
    select score as threshold, sum(label) as pos, sum(1 - label) as neg from scored group by score),
  curve as (
    select threshold, pos, neg,
      sum(pos) over (order by threshold desc) as tp, sum(neg) over (order by threshold desc) as fp,
      sum(pos) over () as p, sum(neg) over () as n from points),
  rated as (
    select *, tp / (tp + fp)::double as precision, tp / p::double as recall,
      2 * tp / (tp + fp + p)::double as f1 from curve)"""


def curve(fx):
    return M.precision_recall_curve(fx.scored())


def _confusion_sql(threshold: str, source: str = "scored") -> str:
    return f"""select count(*) filter (score < {threshold} and label = 0) as tn,
      count(*) filter (score >= {threshold} and label = 0) as fp,
      count(*) filter (score < {threshold} and label = 1) as fn,
      count(*) filter (score >= {threshold} and label = 1) as tp from {source}"""


@query("a04_confusion_matrix", _confusion_sql("0.005"), "scored")
def _(fx):
    return M.confusion(fx.scored(), 0.005)


RATES = """tn, fp, fn, tp,
  case when tp + fp > 0 then tp / (tp + fp)::double else 0.0::double end as precision,
  case when tp + fn > 0 then tp / (tp + fn)::double else 0.0::double end as recall,
  case when 2 * tp + fp + fn > 0 then 2 * tp / (2 * tp + fp + fn)::double
       else 0.0::double end as f1,
  case when fp + tn > 0 then fp / (fp + tn)::double else 0.0::double end as fpr"""


@query("a05_rates", f"select {RATES} from ({_confusion_sql('0.005')})", "scored")
def _(fx):
    return M.with_rates(M.confusion(fx.scored(), 0.005))


@query(
    "a06_roc_auc",
    f"""+{CURVE} select round(sum((tp - pos / 2.0::double) * neg) / (max(p) * max(n))::double, 9)
        as roc_auc from curve""",
    "scored",
)
def _(fx):
    return M.ranking_scores(curve(fx)).select(F.round("roc_auc", 9).alias("roc_auc"))


@query(
    "a06_binned_ranking",
    """+bins as (select floor(score * 64) / 64 as bin, sum(label) as pos, sum(1 - label) as neg
               from scored group by 1),
       summed as (select *, sum(pos) over (order by bin desc) as tp, sum(pos) over () as p,
                    sum(neg) over () as n from bins)
       select round(sum((tp - pos / 2.0::double) * neg) / (max(p) * max(n))::double, 9) as roc_auc,
              round(sum(pos * neg) / 2.0::double / (max(p) * max(n)), 9) as may_be_off,
              true as auc_is_between, true as precision_is_between from summed""",
    "scored",
)
def _(fx):
    """Scores in 64 bins: the area, how far it may be off, and that both exact scores lie within."""
    bounds = M.ranking_bounds(M.binned_curve(fx.scored(), bins=64))
    exact = M.ranking_scores(curve(fx)).first()
    between = {
        "auc_is_between": ("roc_auc", "roc_auc_low", "roc_auc_high"),
        "precision_is_between": ("avg_precision", "avg_precision_low", "avg_precision_high"),
    }
    return bounds.select(
        F.round("roc_auc", 9).alias("roc_auc"),
        F.round(F.col("roc_auc_high") - F.col("roc_auc"), 9).alias("may_be_off"),
        *[
            F.lit(exact[value]).between(F.col(low) - 1e-12, F.col(high) + 1e-12).alias(name)
            for name, (value, low, high) in between.items()
        ],
    )


@query(
    "a07_average_precision",
    f"+{CURVE} select round(sum(pos * precision) / max(p)::double, 9) as avg_precision from rated",
    "scored",
)
def _(fx):
    return M.ranking_scores(curve(fx)).select(
        F.round("avg_precision", 9).alias("avg_precision")
    )


@query(
    "a08_precision_recall_curve",
    f"""+{CURVE} select threshold, cast(tp as bigint) as tp, cast(fp as bigint) as fp,
        precision, recall from rated""",
    "scored",
)
def _(fx):
    return curve(fx).select("threshold", "tp", "fp", "precision", "recall")


@query("a09_base_rate", "select avg(label) as base_rate from scored", "scored")
def _(fx):
    return M.base_rate(fx.scored())


def _metrics_sql(kind: str, threshold: str) -> str:
    return f"""select '{kind}' as kind, {RATES}, cast(th as double) as threshold,
      round(roc, 9) as roc_auc, round(ap, 9) as avg_precision
      from (select {threshold} as th,
              cast(sum(case when threshold < {threshold} then neg else 0 end) as bigint) as tn,
              cast(sum(case when threshold >= {threshold} then neg else 0 end) as bigint) as fp,
              cast(sum(case when threshold < {threshold} then pos else 0 end) as bigint) as fn,
              cast(sum(case when threshold >= {threshold} then pos else 0 end) as bigint) as tp,
              sum((tp - pos / 2.0::double) * neg) / (max(p) * max(n))::double as roc,
              sum(pos * precision) / max(p)::double as ap from rated)"""


BEST = "(select threshold from rated order by f1 desc, threshold limit 1)"
TWO_ROWS = f"+{CURVE} {_metrics_sql('default', '0.5')} union all {_metrics_sql('best', BEST)}"


def evaluated(fx):
    return rounded(V.evaluate(fx.scored(), "label", "score"), 9, "roc_auc", "avg_precision")


@query("l09_evaluate", TWO_ROWS, "scored")
def _(fx):
    return evaluated(fx)


def _report_sql(name: str, source: str) -> str:
    """The two rows of one model; ``source`` holds its labels and scores."""
    curve = CURVE.replace("from scored", f"from {source}")
    for view in ("points", "curve", "rated"):
        curve = re.sub(rf"\b{view}\b", f"{name}_{view}", curve)
    body = " union all ".join(
        f"select '{name}' as model, * from ({_metrics_sql(kind, at)})"
        for kind, at in (("default", "0.5"), ("best", BEST))
    )
    return curve, re.sub(r"\brated\b", f"{name}_rated", body)


_FIRST, _SECOND = _report_sql("first", "scored"), _report_sql("second", "other")


@query(
    "a10_metrics_table",
    f"""+other as (select label, round(0.7 - score / 2, 6) as score from scored),
       {_FIRST[0]}, {_SECOND[0]} {_FIRST[1]} union all {_SECOND[1]}""",
    "scored",
)
def _(fx):
    """Two models: the second prefers what the first does not."""
    second = fx.scored().withColumn("score", F.round(0.7 - F.col("score") / 2, 6))
    report = V.compare({"first": fx.scored(), "second": second}, "label", "score")
    return rounded(report, 9, "roc_auc", "avg_precision")


@query(
    "k06_best_threshold",
    f"+{CURVE} select threshold, f1 from rated order by f1 desc, threshold limit 1",
    "scored",
)
def _(fx):
    return M.best_threshold(curve(fx))


@query(
    "k07_nearest_point",
    f"""+{CURVE} select threshold, precision, recall from rated
        order by abs(threshold - 0.1), threshold limit 1""",
    "scored",
)
def _(fx):
    return M.nearest_point(curve(fx), 0.1).select("threshold", "precision", "recall")


# -------------------------------------------------------------------------------- oversampling


def minority_points(fx):
    """Fraud rows as vectors of whole numbers, all different because of the time."""
    return (
        fx.transactions()
        .filter(F.col(S.LABEL) == 1)
        .select(
            F.col(ID).alias("point"),
            F.array(
                F.round(F.col("transaction_amount_usd") * 100).cast("double"),
                F.col("merchant_id").cast("double"),
                F.unix_millis("transaction_timestamp").cast("double") - 1.7e12,
            ).alias("vector"),
        )
    )


J10_SQL = """+fraud as (select transaction_id, cast(usd * 100 as bigint) as x, merchant_id as y,
                  epoch_ms(transaction_timestamp) as z from tx where is_fraudulent = 1),
       pairs as (select a.transaction_id as point, b.transaction_id as neighbour,
           row_number() over (partition by a.transaction_id order by
             (a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2, b.transaction_id) as rank
         from fraud a join fraud b on a.transaction_id <> b.transaction_id)
       select point, cast(rank as integer) as rank, neighbour from pairs where rank <= 5"""


@query("j10_minority_neighbours", J10_SQL, "tx")
def _(fx):
    found = O.nearest_neighbours(minority_points(fx), pivots=16, block_points=128)
    return found.select("point", "rank", "neighbour")


@query("j10_minority_neighbours_default", J10_SQL, "tx")
def _(fx):
    """The same with the pivots and blocks that the number of points asks for."""
    return O.nearest_neighbours(minority_points(fx)).select("point", "rank", "neighbour")


@query(
    "j10_approximate_neighbours",
    """select count(*) as points, true as is_reached, true as is_measured_truly
       from tx where is_fraudulent = 1""",
    "tx",
)
def _(fx):
    """Small leaves, so that trees have something to miss: the recall that was measured on a sample is
    that of all points, as exact neighbours show, and reaches what was asked for."""
    points = minority_points(fx)
    scale = points.agg(*[F.stddev_pop(F.col("vector")[i]).alias(f"s{i}") for i in range(3)]).first()
    even = F.array(*[F.col("vector")[i] / (scale[i] or 1.0) for i in range(3)])
    points = materialize(points.withColumn("vector", even))
    found = A.approximate_neighbours(points, settings=A.Settings(trees=2, leaf=16, block=64))
    exact = O.nearest_neighbours(points).groupBy("point").agg(
        F.max("distance").alias("bound"), F.max("rank").alias("others")
    )
    true_recall = A.recall_of(found.neighbours, exact)
    return points.agg(F.count(F.lit(1)).alias("points")).select(
        "points",
        F.lit(found.recall >= 0.9).alias("is_reached"),
        F.lit(abs(found.recall - true_recall) < 0.1).alias("is_measured_truly"),
    )


@query(
    "l03_oversampled_classes",
    f"""select c as is_fraudulent, n as rows from
        (values (0), (1)) as v(c),
        (select greatest(count(*) filter (is_fraudulent = 0), count(*) filter (is_fraudulent = 1))
           as n from tx where not ({HASH}))""",
    "tx",
)
def _(fx):
    prepared = D.prepare(feature_table(fx))
    rows = O.oversample(prepared.train, prepared.inputs, ID)
    return rows.groupBy(S.LABEL).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "u04_rows_between_named_ends",
    f"""select n - f as made, true as between_ends, true as ends_are_near, true as starts_evenly
        from (select count(*) filter (is_fraudulent = 0) as n, count(*) filter (is_fraudulent = 1) as f
              from tx where not ({HASH}))""",
    "tx",
)
def _(fx):
    """Each made row names its start and the neighbour and lies between the two, in every input; the
    neighbour is one of the five nearest of the start; all starts serve equally often, to one."""
    prepared = D.prepare(feature_table(fx))
    train = prepared.train.fillna(0.0, subset=prepared.inputs)
    rows = O.oversample(train, prepared.inputs, ID, named=True)
    vector = F.array(*[F.col(f"`{c}`") for c in prepared.inputs])
    known = train.filter(F.col(S.LABEL) == 1).select(F.col(ID).cast("string").alias("id"), vector.alias("at"))
    ends = {
        name: known.select(F.col("id").alias(f"{name}_id"), F.col("at").alias(name))
        for name in ("start", "neighbour")
    }
    made = rows.filter(F.col("start_id").isNotNull()).select(
        "start_id", F.col("neighbour_id").alias("named"), "step", vector.alias("made")
    )
    # Points are named by ids as they are: as texts, 10 would come before 9 where oversampling prefers 9.
    minority = train.filter(F.col(S.LABEL) == 1).select(ID, vector.alias("vector"))
    points = materialize(O.distinct_points(minority, ID))
    named = {"start_id": F.col("point").cast("string"), "neighbour_id": F.col("neighbour").cast("string")}
    near = O.nearest_neighbours(points).withColumns(named).select(*named, F.lit(True).alias("near"))
    # The few neighbours that a start's rows name come to it as a list, so that the made rows, of which
    # there may be many more, are shuffled once and not for each of the three tables.
    listed = (
        made.select("start_id", F.col("named").alias("neighbour_id"))
        .distinct()
        .join(near, ["start_id", "neighbour_id"], "left")
        .join(ends["neighbour"], "neighbour_id")
        .groupBy("start_id")
        .agg(F.collect_list(F.struct("neighbour_id", "neighbour", "near")).alias("ends"))
        .join(ends["start"], "start_id")
    )
    own = F.filter("ends", lambda end: end["neighbour_id"] == F.col("named"))
    joined = (
        made.join(listed, "start_id")
        .select("start_id", "start", "step", "made", F.explode(own).alias("end"))
        .select("start_id", "start", "step", "made", "end.*")
    )
    on_line = F.forall(
        F.zip_with(
            "made",
            F.zip_with("start", "neighbour", lambda a, b: a + F.col("step") * (b - a)),
            lambda x, y: F.abs(x - y) < 1e-9,
        ),
        lambda held: held,
    ) & F.col("step").between(0, 1)
    per_start = joined.groupBy("start_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(on_line).alias("on_line"),
        F.count_if(F.col("near") | (F.col("start_id") == F.col("neighbour_id"))).alias("near"),
    ).join(points.select(F.col("point").cast("string").alias("start_id"), "copies"), "start_id")
    each = F.col("n") / F.col("copies")
    return per_start.agg(
        F.sum("n").alias("made"),
        (F.sum("on_line") == F.sum("n")).alias("between_ends"),
        (F.sum("near") == F.sum("n")).alias("ends_are_near"),
        (F.max(each) - F.min(each) <= 1).alias("starts_evenly"),
    )


@query(
    "u04_oversampled_rows",
    f"""select is_made, is_fraudulent, cast(n as bigint) as rows, cast(n as bigint) as between from
        (select false as is_made, is_fraudulent, count(*) as n from tx where not ({HASH}) group by all
         union all
         select true, 1, count(*) filter (is_fraudulent = 0) - count(*) filter (is_fraudulent = 1)
         from tx where not ({HASH}))""",
    "tx",
)
def _(fx):
    """Rows by origin and class, and how many lie between the least and the largest values that
    rows of their class have in the training part."""
    prepared = D.prepare(feature_table(fx))
    rows = O.oversample(prepared.train, prepared.inputs, ID)
    made = F.col(ID).contains("~")
    values = [f"`{c}`" for c in prepared.inputs]
    # One row per class, from the rows themselves: the made ones are made once and written nowhere.
    known = prepared.train.filter(~made).groupBy(S.LABEL).agg(
        F.array(*[F.min(v) for v in values]).alias("least"),
        F.array(*[F.max(v) for v in values]).alias("most"),
    )
    inside = [
        F.coalesce(
            F.col(v).between(F.col("least")[i] - 1e-9, F.col("most")[i] + 1e-9), F.lit(True)
        )
        for i, v in enumerate(values)
    ]
    counted = rows.join(F.broadcast(known), S.LABEL).groupBy(made.alias("is_made"), S.LABEL)
    return counted.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(reduce(Column.__and__, inside)).alias("between"),
    )


# -------------------------------------------------------------------------------------- models


@query("p16_input_vector", _prepared_sql("transaction_id, is_fraudulent", "0.0::double"), "txm pm")
def _(fx):
    """The vector that a scorer makes of a raw feature row, an entry per column."""
    features = feature_table(fx)
    prepared = D.prepare(features)
    rows = features
    for stage in L.preparation_stages(D.input_expressions(), prepared.scaling):
        rows = stage.transform(rows)
    rows = rows.withColumn("inputs", vector_to_array(L.VECTOR))
    entries = [F.round(F.col("inputs")[i], 4).alias(c) for i, c in enumerate(prepared.inputs)]
    return rows.select(ID, S.LABEL, *entries)


# What a fitted model says depends on its library; that it scores every transaction with
# probabilities, and predicts by its threshold, does not.
SCORED = "select transaction_id, is_fraudulent, true as is_probability from tx"


def _trained(fx, name: str, **options):
    """Trained on the training part, then all transactions scored."""
    features = feature_table(fx)
    scored = L.score(L.train(features, name, **options), features)
    return scored.select(
        ID, S.LABEL, F.col("fraud_probability").between(0, 1).alias("is_probability")
    )


@query("l04_boosted_trees", SCORED, "tx")
def _(fx):
    return _trained(fx, "gbt")


@query("l05_random_forest", SCORED, "tx")
def _(fx):
    return _trained(fx, "rf")


@query("l06_perceptron", SCORED, "tx")
def _(fx):
    return _trained(fx, "mlp")


@query(
    "l10_batch_scoring",
    "select transaction_id, true as sums_to_one, true as follows_threshold from tx",
    "tx",
)
def _(fx):
    """Both class probabilities and the prediction at the stored threshold."""
    features = feature_table(fx)
    model = L.with_threshold(L.train(features, "rf"), 0.3)
    scored = L.score(model, features)
    predicted = M.predictions(scored, L.alert_threshold(model), "fraud_probability")
    total = F.col("probabilities")[0] + F.col("fraud_probability")
    return predicted.select(
        ID,
        (F.abs(total - 1) < 1e-9).alias("sums_to_one"),
        ((F.col("prediction") == 1) == (F.col("fraud_probability") >= 0.3)).alias("follows_threshold"),
    )


_BASE = f"""+base as (select is_fraudulent as label, floor(usd / 5) as band, {HASH} as is_test from tx),
  rates as (select band, (sum(label) + 1) / (count(*) + 2)::double as rate from base
            where not is_test group by band),
  scored as (select label, coalesce(rate, 0.5::double) as score
             from base left join rates using (band) where is_test),
  {CURVE}"""

#: Fewer trees than in production, so that three models are trained in reasonable time.
_COMPARED = {"gbt": {"maxIter": 20}, "rf": {"numTrees": 50}, "mlp": {}}


@query(
    "l09_models_against_bands",
    f"""{_BASE}, auc as (
          select round(sum((tp - pos / 2.0::double) * neg) / (max(p) * max(n))::double, 6) as v from curve)
        select model, v as bands_auc, true as is_better, true as is_good
        from auc, (values ('gbt'), ('rf'), ('mlp')) as m(model)""",
    "tx",
)
def _(fx):
    """Held-out ROC-AUC of each model against an independent fit, the fraud rates of bands of the
    amount: every model must be better than it, and reach 0.95."""
    features = feature_table(fx)
    flagged = D.with_split(features)
    banded = flagged.select(
        ID, "is_test", F.col(S.LABEL).alias("label"), F.floor(F.col("transaction_amount_usd") / 5).alias("band")
    )
    rates = (
        banded.filter(~F.col("is_test"))
        .groupBy("band")
        .agg(((F.sum("label") + 1) / (F.count(F.lit(1)) + 2)).alias("rate"))
    )
    known = banded.join(rates, "band", "left").select(
        ID, "is_test", "label", F.coalesce("rate", F.lit(0.5)).alias("score")
    )
    known = materialize(known.filter("is_test"))

    def auc(rows, score):
        return M.ranking_scores(M.precision_recall_curve(rows, "label", score)).first()["roc_auc"]

    bands = auc(known, "score")
    found = []
    for name, settings in _COMPARED.items():
        scored = L.score(L.train(features, name, settings=settings), features)
        rows = materialize(known.join(scored.select(ID, "fraud_probability"), ID))
        reached = auc(rows, "fraud_probability")
        found.append((name, round(bands, 6), reached > bands, reached >= 0.95))
    return fx.spark.createDataFrame(
        found, "model string, bands_auc double, is_better boolean, is_good boolean"
    )


@query(
    "k08_top_importances",
    """select cast(count(*) as bigint) as inputs, true as in_order, true as are_shares
       from (select transaction_id from tx limit 20)""",
    "tx",
)
def _(fx):
    """The twenty most important inputs: all known, largest first, together at most 1."""
    names = L.input_names()
    top = L.top_importances(L.train(feature_table(fx), "rf"), fx.spark, names)
    ranked = top.withColumn("place", F.monotonically_increasing_id())
    ahead = F.lag("importance").over(Window.orderBy("place"))  # twenty rows
    return ranked.withColumn("ahead", ahead).agg(
        F.count_if(F.col("feature").isin(names)).alias("inputs"),
        F.every(F.coalesce(F.col("ahead") >= F.col("importance"), F.lit(True))).alias("in_order"),
        (F.every(F.col("importance") >= 0) & (F.sum("importance") <= 1 + 1e-9)).alias("are_shares"),
    )


@query("s14_saved_model", "select transaction_id, true as same from tx", "tx")
def _(fx):
    """A model read back from its folder scores every transaction as the fitted one does."""
    features = feature_table(fx)
    model = L.train(features, "mlp")
    folder = shared_folder(fx.spark, "models")
    L.save(model, folder, "mlp")
    scored = [
        L.score(m, features).select(ID, F.col("fraud_probability").alias(name))
        for name, m in (("fitted", model), ("loaded", L.load(fx.spark, folder, "mlp")))
    ]
    joined = scored[0].join(scored[1], ID)
    return joined.select(ID, (F.col("fitted") == F.col("loaded")).alias("same"))


@query(
    "r05_alert_sinks",
    """select transaction_id, user_id, true as is_above, true as in_both, true as has_id
       from (select transaction_id, user_id from tx)""",
    "tx",
)
def _(fx):
    """All transactions scored and alerted, with a threshold of 0 and so an alert for each: the
    alert table has gapless ids, and what is published is what is stored."""
    features = feature_table(fx)
    model = L.with_threshold(L.train(features, "mlp"), 0.0)
    root = shared_folder(fx.spark, "alerts")
    stores = R.Stores(*[f"{root}/{n}" for n in ("history", "alerts", "bad", "state")])
    late = F.col(ID) % 2 == 0
    for batch, part in enumerate((features.filter(~late), features.filter(late))):
        R.emit(
            part,
            stores,
            model,
            "mlp",
            publish=lambda df: df.write.mode("append").parquet(f"{root}/published"),
            batch_id=batch,
        )
    stored = R.stored_alerts(fx.spark, stores.alerts)
    sent = fx.spark.read.parquet(f"{root}/published").select(
        "alert_id", ID, F.lit(True).alias("sent")
    )
    rows = stored.agg(F.count(F.lit(1)).alias("rows"), F.max("alert_id").alias("last"))
    gapless = rows.select((F.col("rows") == F.col("last")).alias("gapless"))
    return stored.join(sent, ["alert_id", ID], "left").join(F.broadcast(gapless)).select(
        F.col(ID).cast("bigint").alias(ID),
        "user_id",
        F.col("fraud_probability").between(0, 1).alias("is_above"),
        F.coalesce("sent", F.lit(False)).alias("in_both"),
        (F.col("gapless") & (F.col("alert_id") > 0)).alias("has_id"),
    )


@query("s13_metrics_csv", TWO_ROWS, "scored")
def _(fx):
    """The report as the CSV file holds it."""
    path = f"{shared_folder(fx.spark, 'metrics')}/report"
    report = evaluated(fx)
    write_metrics(report, path)
    return fx.spark.read.option("header", True).schema(report.schema).csv(path)
