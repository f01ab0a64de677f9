"""DuckDB oracle SQL for the driver queries.

Each statement is an independent, brute-force formulation of the same
semantics over the pre-registered tables (full products inside a video,
window ranking instead of blocked search, explicit arithmetic in the same
association order as the Spark expressions). Doubles are rounded with
``floor(x * 1e6 + 0.5) / 1e6`` exactly as in ``queries.r6``.
"""

from __future__ import annotations

from reverbkit.constants import (
    CENTROID_LOGIT_SCALE,
    CES_LAMBDA,
    EMOTIONS,
    RELATIONSHIP_MATRIX,
    WRS_BETA,
)


def D(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def r6(e: str) -> str:
    return f"(floor(({e}) * 1e6 + 0.5) / 1e6)"


def r3(e: str) -> str:
    return f"(floor(({e}) * 1e3 + 0.5) / 1e3)"


def r2(e: str) -> str:
    return f"(floor(({e}) * 1e2 + 0.5) / 1e2)"


def fsum(lst: str) -> str:
    return f"list_reduce({lst}, lambda a, b: a + b)"


def norm(v: str) -> str:
    return f"sqrt({fsum(f'list_transform({v}, lambda x: x * x)')})"


def dotp(a: str, b: str) -> str:
    return fsum(f"list_transform(list_zip({a}, {b}), lambda z: z[1] * z[2])")


EMO_LIST = "[" + ", ".join(f"'{e}'" for e in EMOTIONS) + "]"
MATRIX = "CAST([" + ", ".join("[" + ", ".join(repr(float(v)) for v in row) + "]" for row in RELATIONSHIP_MATRIX) + "] AS DOUBLE[][])"


def M(t_idx: str, c_idx: str) -> str:
    return f"({MATRIX}[({t_idx}) + 1][({c_idx}) + 1])"


def relation_cte() -> str:
    """CTEs ending in ``flow``: relations and sentiment of the rows of ``best``
    (``ctop`` and ``ttop`` are the top-3 lists of comment and chunk)."""
    return f"""
rel AS (
  SELECT *,
    [ {', '.join(_ces_sql(i) for i in range(1, 4))} ] AS ces
  FROM best
),
rel2 AS (
  SELECT *,
    ttop[1].conf * ctop[1].conf * {M('ttop[1].idx', 'ctop[1].idx')} + {D(WRS_BETA)} * ces[1] AS wrs,
    ctop[list_position(ces, list_max(ces))].emotion AS final_emotion
  FROM rel
),
flow AS (
  SELECT *,
    CASE WHEN wrs > -0.2 THEN NULL
         WHEN wrs > -0.5 THEN 'moderate_mismatch'
         WHEN wrs <= -0.5 AND ttop[1].conf > 0.7 AND ctop[1].conf > 0.7
              AND ttop[1].emotion IN ('Joy', 'Love') AND ctop[1].emotion IN ('Anger', 'Sadness') THEN 'high_sarcasm'
         WHEN wrs <= -0.5 AND ttop[1].conf > 0.7 AND ctop[1].conf > 0.7
              AND ttop[1].emotion IN ('Sadness', 'Anger') AND ctop[1].emotion IN ('Joy', 'Love') THEN 'high_irony'
         ELSE NULL END AS ecf,
    CASE WHEN ctop[1].conf < 0.5 THEN 'Neutral'
         WHEN ctop[1].emotion IN ('Anger', 'Sadness', 'Fear') THEN 'Negative'
         ELSE 'Positive' END AS sentiment
  FROM rel2
)
"""


def emb_cte() -> str:
    """Shared CTEs: roles, centroids, probabilities, top-3, nearest chunk, relations."""
    return f"""
WITH rws AS (
  SELECT vec_id, CAST(label AS INTEGER) AS label, CAST(embedding AS DOUBLE[]) AS vec,
         (vec_id // 10) % 5 AS video_id, (vec_id % 10 = 0) AS is_chunk
  FROM embeddings
),
rows2 AS (SELECT *, {norm('vec')} AS nrm FROM rws),
dims AS (
  SELECT label, unnest(range(len(vec))) AS pos, unnest(vec) AS x FROM rows2 WHERE label BETWEEN 0 AND 5
),
cent AS (
  SELECT label, list(s ORDER BY pos) AS cvec
  FROM (SELECT label, pos, sum(x) AS s FROM dims GROUP BY label, pos) GROUP BY label
),
cent2 AS (SELECT label, cvec, {norm('cvec')} AS cn FROM cent),
logit AS (
  SELECT r.vec_id, c.label,
         {D(CENTROID_LOGIT_SCALE)} * CASE WHEN r.nrm * c.cn > 0 THEN {dotp('r.vec', 'c.cvec')} / (r.nrm * c.cn) ELSE {D(0)} END AS lg
  FROM rows2 r CROSS JOIN cent2 c
),
lgs AS (SELECT vec_id, list(lg ORDER BY label) AS lg FROM logit GROUP BY vec_id),
ex AS (SELECT vec_id, list_transform(lg, lambda x: exp(x - list_max(lg))) AS e FROM lgs),
pr AS (SELECT vec_id, list_transform(e, lambda x: x / {fsum('e')}) AS probs FROM ex),
scored AS (
  SELECT r.vec_id, r.video_id, r.is_chunk, r.label, r.vec, r.nrm, p.probs,
         list_transform(
           list_sort(list_transform(p.probs, lambda x, i: {{'neg': -x, 'idx': i - 1, 'p': x}}))[1:3],
           lambda s: {{'emotion': {EMO_LIST}[s.idx + 1], 'conf': s.p, 'idx': s.idx}}) AS top3,
         CAST(list_position(p.probs, list_max(p.probs)) - 1 AS INTEGER) AS pred
  FROM rows2 r JOIN pr p USING (vec_id)
),
cm AS (SELECT video_id, vec_id AS comment_id, vec, nrm, top3 FROM scored WHERE NOT is_chunk),
ck AS (SELECT video_id, CAST(vec_id // 50 + 1 AS INTEGER) AS chunk_index, vec, nrm, top3 FROM scored WHERE is_chunk),
pairs AS (
  SELECT c.video_id, c.comment_id, k.chunk_index, c.top3 AS ctop, k.top3 AS ttop,
         CASE WHEN c.nrm * k.nrm > 0 THEN {dotp('c.vec', 'k.vec')} / (c.nrm * k.nrm) ELSE {D(0)} END AS sim
  FROM cm c JOIN ck k ON c.video_id = k.video_id
),
best AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY comment_id ORDER BY floor(sim * 1e12 + 0.5) / 1e12 DESC, chunk_index) AS rn
    FROM pairs) WHERE rn = 1
),
{relation_cte()}"""


def _ces_sql(i: int) -> str:
    terms = [f"ctop[{i}].conf"]
    for j in range(1, 4):
        terms.append(f"{D(CES_LAMBDA)} * (ttop[{j}].conf * {M(f'ttop[{j}].idx', f'ctop[{i}].idx')})")
    return " + ".join(terms)


def flat(top: str, prefix: str) -> str:
    cols = [f"{top}[{i}].emotion AS {prefix}_emotion{i}" for i in range(1, 4)]
    cols += [f"{r6(f'{top}[{i}].conf')} AS {prefix}_conf{i}" for i in range(1, 4)]
    return ", ".join(cols)


ORACLE: dict[str, str] = {}

ORACLE["nearest_chunk"] = emb_cte() + f"""
SELECT video_id, comment_id, chunk_index, {r6('sim')} AS similarity FROM flow
"""

ORACLE["top3_emotions"] = emb_cte() + f"""
SELECT vec_id, video_id, CASE WHEN is_chunk THEN 'chunk' ELSE 'comment' END AS role,
       {flat('top3', 'top')}, pred AS pred_label
FROM scored
"""

ORACLE["comment_chunk_emotions"] = emb_cte() + f"""
SELECT video_id, comment_id, chunk_index, {flat('ctop', 'comment')}, {flat('ttop', 'transcript')} FROM flow
"""

ORACLE["ces_scores"] = emb_cte() + f"""
SELECT video_id, comment_id,
  {', '.join(f"ctop[{i}].emotion AS comment_emotion{i}, {r6(f'ces[{i}]')} AS ces{i}" for i in range(1, 4))}
FROM flow
"""

ORACLE["wrs_ecf"] = emb_cte() + f"""
SELECT video_id, comment_id, {r6('wrs')} AS wrs, ecf FROM flow
"""

ORACLE["final_emotion"] = emb_cte() + """
SELECT video_id, comment_id, ctop[1].emotion AS top_emotion, final_emotion,
       final_emotion <> ctop[1].emotion AS changed
FROM flow
"""

ORACLE["ces_table"] = emb_cte() + f"""
SELECT video_id, comment_id, final_emotion, {r6('wrs')} AS wrs, ecf,
  {', '.join(f"CASE WHEN list_position(list_transform(ctop, lambda c: c.emotion), '{e}') > 0 THEN {r6(f'ces[list_position(list_transform(ctop, lambda c: c.emotion), {chr(39)}{e}{chr(39)})]')} END AS {e.lower()}" for e in EMOTIONS)}
FROM flow
"""

ORACLE["sentiment"] = emb_cte() + f"""
SELECT video_id, comment_id, ctop[1].emotion AS top_emotion, {r6('ctop[1].conf')} AS top_conf, sentiment FROM flow
"""

ORACLE["comment_report"] = emb_cte() + f"""
SELECT video_id, comment_id, ctop[1].emotion AS top_emotion, {r3('ctop[1].conf')} AS confidence, sentiment FROM flow
"""

ORACLE["sentiment_distribution"] = emb_cte() + """
SELECT video_id, sentiment, count(*) AS n FROM flow GROUP BY video_id, sentiment
"""

ORACLE["emotion_distribution"] = emb_cte() + """
SELECT video_id, ctop[1].emotion AS emotion, count(*) AS n FROM flow GROUP BY video_id, ctop[1].emotion
"""

ORACLE["overall_opinion"] = emb_cte() + """
, vids AS (SELECT DISTINCT video_id FROM rws),
sc AS (SELECT video_id, sentiment AS v, count(*) AS n FROM flow GROUP BY ALL),
ec AS (SELECT video_id, ctop[1].emotion AS v, count(*) AS n FROM flow GROUP BY ALL),
sm AS (SELECT video_id, v FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY n DESC, v) AS rn FROM sc) WHERE rn = 1),
em AS (SELECT video_id, v FROM (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY n DESC, v) AS rn FROM ec) WHERE rn = 1),
nc AS (SELECT video_id, count(*) AS n FROM flow GROUP BY video_id)
SELECT vids.video_id, coalesce(nc.n, 0) AS n_comments,
       coalesce(sm.v, 'N/A') AS overall_sentiment, coalesce(em.v, 'N/A') AS overall_emotion
FROM vids LEFT JOIN nc USING (video_id) LEFT JOIN sm USING (video_id) LEFT JOIN em USING (video_id)
"""


# ---------------------------------------------------------------------------
# dataset preparation and evaluation
# ---------------------------------------------------------------------------

ORACLE["label_distribution"] = f"""
WITH c AS (SELECT CAST(label AS INTEGER) AS label, count(*) AS n FROM embeddings GROUP BY 1)
SELECT label, CASE WHEN label BETWEEN 0 AND 5 THEN {EMO_LIST}[label + 1] END AS emotion, n,
       (SELECT count(*) FROM c) AS n_labels
FROM c
"""

ORACLE["class_weights"] = """
WITH c AS (SELECT CAST(label AS INTEGER) AS label, count(*) AS n FROM embeddings WHERE label IS NOT NULL GROUP BY 1),
t AS (SELECT CAST(sum(n) AS DOUBLE) AS nn, CAST(count(*) AS DOUBLE) AS k FROM c)
SELECT label, n, """ + r6("t.nn / (t.k * n)") + """ AS weight FROM c, t
"""

_BAL = """
lab AS (SELECT vec_id, CAST(label AS INTEGER) AS label FROM embeddings WHERE label IS NOT NULL),
mn AS (SELECT min(c) AS m FROM (SELECT label, count(*) AS c FROM lab GROUP BY label)),
bal AS (
  SELECT vec_id, label FROM (
    SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('42' || CAST(vec_id AS VARCHAR)), vec_id) AS rk FROM lab)
  WHERE rk <= (SELECT m FROM mn)
)"""

ORACLE["undersample"] = "WITH " + _BAL + """
SELECT vec_id, label FROM bal
"""

ORACLE["stratified_split"] = "WITH " + _BAL + """,
rk AS (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('split42' || CAST(vec_id AS VARCHAR)), vec_id) AS r,
         count(*) OVER (PARTITION BY label) AS n
  FROM bal)
SELECT vec_id, label,
  CASE WHEN r <= (n * 70) // 100 THEN 'train' WHEN r <= (n * 85) // 100 THEN 'val' ELSE 'test' END AS split
FROM rk
"""

_CONF = """
, lab AS (SELECT * FROM scored WHERE label BETWEEN 0 AND 5),
conf AS (SELECT label, pred, count(*) AS n FROM lab GROUP BY label, pred),
sup AS (SELECT label AS cls, sum(n) AS support, sum(CASE WHEN label = pred THEN n ELSE 0 END) AS tp FROM conf GROUP BY 1),
prd AS (SELECT pred AS cls, sum(n) AS predicted FROM conf GROUP BY 1),
pc0 AS (
  SELECT coalesce(s.cls, p.cls) AS cls, coalesce(tp, 0) AS tp, coalesce(support, 0) AS support,
         coalesce(predicted, 0) AS predicted
  FROM sup s FULL OUTER JOIN prd p ON s.cls = p.cls),
pc1 AS (
  SELECT *, CASE WHEN predicted > 0 THEN CAST(tp AS DOUBLE) / predicted ELSE 0.0 END AS precision,
            CASE WHEN support > 0 THEN CAST(tp AS DOUBLE) / support ELSE 0.0 END AS recall
  FROM pc0),
pc AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2.0 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
  FROM pc1)
"""

ORACLE["confusion_counts"] = emb_cte() + _CONF + """
SELECT label, pred, n FROM conf
"""

ORACLE["weighted_metrics"] = emb_cte() + _CONF + f"""
SELECT CAST(sum(support) AS BIGINT) AS n,
  {r6('sum(tp) / sum(support)')} AS accuracy,
  {r6('sum(support * precision) / sum(support)')} AS precision,
  {r6('sum(support * recall) / sum(support)')} AS recall,
  {r6('sum(support * f1) / sum(support)')} AS f1
FROM pc
"""

ORACLE["class_report"] = emb_cte() + _CONF + f"""
SELECT coalesce({EMO_LIST}[cls + 1], CAST(cls AS VARCHAR)) AS class,
       {r6('precision')} AS precision, {r6('recall')} AS recall, {r6('f1')} AS f1, CAST(support AS BIGINT) AS support
FROM pc
UNION ALL
SELECT 'macro avg', {r6('avg(precision)')}, {r6('avg(recall)')}, {r6('avg(f1)')}, CAST(sum(support) AS BIGINT) FROM pc
UNION ALL
SELECT 'weighted avg', {r6('sum(support * precision) / sum(support)')}, {r6('sum(support * recall) / sum(support)')},
       {r6('sum(support * f1) / sum(support)')}, CAST(sum(support) AS BIGINT) FROM pc
"""

ORACLE["log_loss"] = emb_cte() + """
, lab AS (SELECT * FROM scored WHERE label BETWEEN 0 AND 5)
SELECT count(*) AS n,
  """ + r6("avg(-ln(least(greatest(probs[label + 1], 1e-15), 1.0 - 1e-15)))") + """ AS log_loss
FROM lab
"""
