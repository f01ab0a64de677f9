"""DuckDB oracle SQL of the training queries: the same optimizer as a recursion
over steps, its state in rows (step, cell, w, m, v)."""

from __future__ import annotations

import hashlib

from reverbkit.operators.minibatch import Settings
from reverbkit.plans.oracle import r6
from reverbkit.plans.training_queries import TEXT_DIMS, TEXT_SETTINGS, VECTOR_DIMS, VECTOR_SETTINGS

#: CTEs ending in labelled(id, label, split) and feats(id, idx, val).
_VECTORS = """
bal AS (
  SELECT vec_id AS id, label, embedding, row_number() OVER (PARTITION BY label ORDER BY md5('42' || CAST(vec_id AS VARCHAR)), vec_id) AS r
  FROM embeddings WHERE label BETWEEN 0 AND 5),
smallest AS (SELECT min(c) AS n FROM (SELECT count(*) AS c FROM bal GROUP BY label)),
ranked AS (
  SELECT id, label, embedding, row_number() OVER (PARTITION BY label ORDER BY md5('split42' || CAST(id AS VARCHAR)), id) AS r, count(*) OVER (PARTITION BY label) AS n
  FROM bal WHERE r <= (SELECT n FROM smallest)),
labelled AS (SELECT id, label, embedding, CASE WHEN r <= (n * 70) // 100 THEN 'train' WHEN r <= (n * 85) // 100 THEN 'val' ELSE 'test' END AS split FROM ranked),
feats AS (SELECT id, CAST(unnest(embedding) AS DOUBLE) AS val, generate_subscripts(embedding, 1) - 1 AS idx FROM labelled)
"""

_TEXTS = f"""
ranked AS (
  SELECT doc_id AS id, CAST(quality AS INTEGER) AS label, text,
         row_number() OVER (PARTITION BY quality ORDER BY md5('split42' || CAST(doc_id AS VARCHAR)), doc_id) AS r, count(*) OVER (PARTITION BY quality) AS n
  FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL),
labelled AS (SELECT id, label, text, CASE WHEN r <= (n * 70) // 100 THEN 'train' WHEN r <= (n * 85) // 100 THEN 'val' ELSE 'test' END AS split FROM ranked),
terms AS (SELECT id, unnest(regexp_extract_all(text, '[\\pL\\pN]+|[^\\pL\\pN\\x00-\\x20]+')) AS t FROM labelled),
places AS (
  SELECT id, CAST('0x' || substr(md5(t), 1, 6) AS INTEGER) % {TEXT_DIMS} AS idx, 1 + ln(count(*)) AS tf
  FROM (SELECT id, lower(t) AS t FROM terms UNION ALL SELECT id, '<caps>' FROM terms WHERE regexp_full_match(t, '\\p{{Lu}}{{2,}}')) GROUP BY 1, 2),
fitted AS (SELECT count(*) AS n FROM labelled WHERE split = 'train'),
idf AS (SELECT idx, count(*) AS df FROM places JOIN labelled USING (id) WHERE split = 'train' GROUP BY idx),
weighed_terms AS (SELECT id, idx, tf * (ln((1.0 + n) / (1 + coalesce(df, 0))) + 1) AS w FROM places CROSS JOIN fitted LEFT JOIN idf USING (idx)),
feats AS (SELECT id, idx, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS val FROM weighed_terms)
"""


def _schedule(s: Settings) -> str:
    """(step, epoch, batch): which mini-batch each step takes."""
    rows, step = [], 0
    for epoch in range(1, s.epochs + 1):
        for batch in sorted(range(s.batches), key=lambda b: hashlib.md5(f"{s.seed}-{epoch}-{b}".encode()).hexdigest()):
            rows.append(f"({step}, {epoch}, {batch})")
            step += 1
    return ", ".join(rows)


def _trained(features: str, classes: int, dims: int, s: Settings) -> str:
    """CTEs up to scored(epoch, split, id, label, k, p) and train_losses(epoch, loss)."""
    width, steps = dims + 1, s.epochs * s.batches
    return f"""
WITH RECURSIVE {features},
schedule(step, epoch, batch) AS (VALUES {_schedule(s)}),
x AS (SELECT id, idx, val FROM feats UNION ALL SELECT id, {dims}, 1.0 FROM labelled),
fit AS (SELECT id, label, CAST('0x' || substr(md5('batch{s.seed}' || CAST(id AS VARCHAR)), 1, 8) AS BIGINT) % {s.batches} AS batch FROM labelled WHERE split = 'train'),
seen AS (SELECT schedule.step, fit.id, fit.label, count(*) OVER (PARTITION BY schedule.step) AS n FROM schedule JOIN fit USING (batch)),
classes AS (SELECT unnest(range({classes})) AS k),
state(step, cell, w, m, v) AS (
  SELECT 0, CAST(c AS INTEGER), 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM range({classes * width}) t(c)
  UNION ALL
  SELECT step, cell, w - {s.rate!r} * ((m / (1 - power({s.beta1!r}, step))) / (sqrt(v / (1 - power({s.beta2!r}, step))) + {s.eps!r}) + {s.decay!r} * w), m, v FROM (
    SELECT u.step + 1 AS step, u.cell, u.w,
           {s.beta1!r} * u.m + (1 - {s.beta1!r}) * coalesce(g.g, 0) AS m,
           {s.beta2!r} * u.v + (1 - {s.beta2!r}) * coalesce(g.g, 0) * coalesce(g.g, 0) AS v
    FROM state u LEFT JOIN (
      SELECT k * {width} + x.idx AS cell, sum((e / e_all - (CASE WHEN label = k THEN 1 ELSE 0 END)) * x.val / n) AS g
      FROM (
        SELECT id, label, n, k, exp(z - max(z) OVER (PARTITION BY id)) AS e, sum(exp(z - zmax)) OVER (PARTITION BY id) AS e_all FROM (
          SELECT id, label, n, k, z, max(z) OVER (PARTITION BY id) AS zmax FROM (
            SELECT seen.id, seen.label, seen.n, s.cell // {width} AS k, sum(x.val * s.w) AS z
            FROM state s JOIN seen ON seen.step = s.step JOIN x ON x.id = seen.id AND x.idx = s.cell % {width}
            GROUP BY ALL))) p
      JOIN x ON x.id = p.id GROUP BY 1) g ON g.cell = u.cell
    WHERE u.step < {steps})),
logits AS (
  SELECT seen.step, 'train' AS split, seen.id, seen.label, s.cell // {width} AS k, sum(x.val * s.w) AS z
  FROM state s JOIN seen ON seen.step = s.step JOIN x ON x.id = seen.id AND x.idx = s.cell % {width} GROUP BY ALL
  UNION ALL
  SELECT s.step, l.split, l.id, l.label, s.cell // {width} AS k, sum(x.val * s.w) AS z
  FROM state s JOIN labelled l ON l.split <> 'train' JOIN x ON x.id = l.id AND x.idx = s.cell % {width}
  WHERE s.step > 0 AND s.step % {s.batches} = 0 GROUP BY ALL),
shares AS (
  SELECT step, split, id, label, k, e / sum(e) OVER (PARTITION BY step, split, id) AS p
  FROM (SELECT *, exp(z - max(z) OVER (PARTITION BY step, split, id)) AS e FROM logits)),
train_losses AS (
  SELECT epoch, avg(loss) AS train_loss FROM (
    SELECT sc.epoch, sc.step, avg(-ln(least(greatest(p, 1e-15), 1))) AS loss FROM shares sh JOIN schedule sc USING (step)
    WHERE split = 'train' AND k = label GROUP BY ALL) GROUP BY epoch),
scored AS (
  SELECT CAST(step // {s.batches} AS INTEGER) AS epoch, split, id, label, arg_min(k, (-p, k)) AS pred, max(CASE WHEN k = label THEN -ln(least(greatest(p, 1e-15), 1)) END) AS loss,
         list(p ORDER BY k) AS probs
  FROM shares WHERE split <> 'train' GROUP BY ALL),
val_losses AS (SELECT epoch, avg(loss) AS loss FROM scored WHERE split = 'val' GROUP BY epoch),
chosen AS (SELECT epoch FROM val_losses ORDER BY loss, epoch LIMIT 1),
told AS (SELECT * FROM scored WHERE split = 'val' OR epoch = (SELECT epoch FROM chosen))
"""


_HISTORY = f""",
totals AS (SELECT split, epoch, count(*) AS n, avg(loss) AS loss, avg(CASE WHEN pred = label THEN 1.0 ELSE 0 END) AS accuracy FROM told GROUP BY ALL),
by_class AS (
  SELECT t.split, t.epoch, c.k,
         count(*) FILTER (WHERE t.label = c.k) AS support, count(*) FILTER (WHERE t.pred = c.k) AS predicted, count(*) FILTER (WHERE t.pred = c.k AND t.label = c.k) AS tp
  FROM told t CROSS JOIN classes c GROUP BY ALL),
rates AS (
  SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS p, CASE WHEN support > 0 THEN tp / support ELSE 0 END AS r FROM by_class),
weighed AS (
  SELECT split, epoch, sum(support * p) / sum(support) AS precision, sum(support * r) / sum(support) AS recall,
         sum(support * CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END) / sum(support) AS f1, max(support) / sum(support) AS majority
  FROM rates GROUP BY ALL)
SELECT t.split, t.epoch, CASE WHEN t.split = 'val' THEN {r6('l.train_loss')} END AS train_loss, {r6('t.loss')} AS loss, {r6('t.accuracy')} AS accuracy,
       {r6('w.precision')} AS precision, {r6('w.recall')} AS recall, {r6('w.f1')} AS f1, {r6('w.majority')} AS majority, CAST(t.n AS BIGINT) AS n
FROM totals t JOIN weighed w USING (split, epoch) JOIN train_losses l USING (epoch)
"""

ORACLE_TRAINING: dict[str, str] = {
    "train_history": _trained(_VECTORS, 6, VECTOR_DIMS, VECTOR_SETTINGS) + _HISTORY,
    "train_eval": _trained(_TEXTS, 2, TEXT_DIMS, TEXT_SETTINGS) + _HISTORY,
    "reloaded_scores": _trained(_VECTORS, 6, VECTOR_DIMS, VECTOR_SETTINGS)
    + "SELECT id AS vec_id, label, CAST(pred AS INTEGER) AS pred, "
    + ", ".join(f"{r6(f'probs[{k + 1}]')} AS p{k}" for k in range(6))
    + f", {r6('loss')} AS loss FROM told WHERE split = 'test'",
}
