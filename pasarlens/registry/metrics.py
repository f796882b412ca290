"""Evaluation of a prediction table."""

from __future__ import annotations

from pyspark.sql import functions as F

from pasarlens import fixtures as fx
from pasarlens.operators import metrics as E
from pasarlens.registry.base import PRED, RANKED, Query, ask, rnd


def rounded(df, *columns, digits=8):
    return df.withColumns({c: F.round(c, digits) for c in columns})


CLASSES = """cells as (select label, prediction, count(*) as n from predictions group by all),
classes as (select distinct class from (select label as class from cells union all select prediction from cells)),
sums as (
  select class, coalesce((select sum(n) from cells where label = class and prediction = class), 0)::double as hit,
    coalesce((select sum(n) from cells where label = class), 0)::double as support,
    coalesce((select sum(n) from cells where prediction = class), 0)::double as guess from classes),
report as (
  select class, case when guess > 0 then hit / guess else 0 end as precision,
    case when support > 0 then hit / support else 0 end as recall,
    case when support + guess > 0 then 2 * hit / (support + guess) else 0 end as f1, hit, support from sums)"""

DCG = """places as (
  select query_id, relevance::double as gain,
    row_number() over (partition by query_id order by score desc, id) as by_score,
    row_number() over (partition by query_id order by relevance desc, id) as by_gain from ranked),
per_query as (
  select k, query_id, sum(case when by_score <= k then gain / log2(by_score + 1) else 0 end) as dcg,
    sum(case when by_gain <= k then gain / log2(by_gain + 1) else 0 end) as ideal
  from places cross join (values (5), (10)) as cut(k) group by k, query_id)"""

QUERIES = [
    Query(
        "classification_report",
        lambda s, d: rounded(E.classification_report(fx.predictions(s, d)), "precision", "recall", "f1"),
        ask(PRED, CLASSES, then=f"""select class, {rnd('precision', 8)} as precision, {rnd('recall', 8)} as recall,
          {rnd('f1', 8)} as f1, cast(support as bigint) as support from report"""),
    ),
    Query(
        "accuracy_f1",
        lambda s, d: rounded(E.accuracy_f1(fx.predictions(s, d)), "accuracy", "f1_weighted"),
        ask(PRED, CLASSES, then=f"""select {rnd('sum(hit) / sum(support)', 8)} as accuracy,
          {rnd('sum(f1 * support) / sum(support)', 8)} as f1_weighted from report"""),
    ),
    Query(
        "confusion_matrix",
        lambda s, d: E.confusion_matrix(fx.predictions(s, d)),
        ask(PRED, then="select label, prediction, count(*) as n_rows from predictions group by all"),
    ),
    Query(
        "roc_auc",
        lambda s, d: rounded(E.roc_auc(fx.predictions(s, d)), "auc"),
        ask(PRED, then=f"""select {rnd('(sum(r) filter (where label = 1) - p * (p + 1) / 2) / (p * n)', 8)} as auc
          from (select label, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2 as r,
                  sum(label) over ()::double as p, sum(1 - label) over ()::double as n from predictions)
          group by p, n"""),
    ),
    Query(
        "regression_metrics",
        lambda s, d: rounded(
            E.regression_metrics(fx.predictions(s, d).withColumn("guess", F.col("score") * 2), "score", "guess"),
            "rmse",
            "mae",
            "r2",
        ),
        ask(PRED, then=f"""select {rnd('sqrt(avg(score * score))', 8)} as rmse, {rnd('avg(abs(score))', 8)} as mae,
          {rnd('1 - avg(score * score) / var_pop(score)', 8)} as r2 from predictions"""),
    ),
    Query(
        "ndcg_at_k",
        lambda s, d: rounded(E.ndcg_at_k(fx.ranked_results(s, d)), "ndcg"),
        ask(RANKED, DCG, then=f"""select k, {rnd('avg(case when ideal > 0 then dcg / ideal else 1 end)', 8)} as ndcg,
          count(*) as n_queries from per_query group by k"""),
    ),
]
