"""Driver query of extracts and their emotions (M12), with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reverbkit.functions.vectors import round_half_up
from reverbkit.operators.models import score_summaries
from reverbkit.operators.summaries import DAMPING, NO_EDGE, PLACES, ROUNDS, SENTENCES, summarise
from reverbkit.plans.flow_queries import LengthScorer
from reverbkit.plans.oracle_text import length_top3
from reverbkit.sources.tables import conversation_segments


def q_summary_emotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An extract per conversation and its top-3 emotions."""
    out = score_summaries(LengthScorer(), summarise(conversation_segments(spark, sf_dir)))
    return out.select(*[round_half_up(F.col(c), 6).alias(c) if "_conf" in c else c for c in out.columns])


SUMMARY_QUERIES = {"summary_emotions": q_summary_emotions}


def _rounds() -> str:
    """A round of the walk, over the written edges."""
    out = ["r0 AS (SELECT video_id, seg, pos, 1.0::DOUBLE AS rank FROM deg)"]
    for i in range(1, ROUNDS + 1):
        out.append(f"""r{i} AS (
  SELECT d.video_id, d.seg, d.pos, {1 - DAMPING!r}::DOUBLE + {DAMPING!r}::DOUBLE * coalesce(sum(e.w * r.rank / o.degree), 0) AS rank
  FROM deg d LEFT JOIN edges e ON e.video_id = d.video_id AND e.seg = d.seg AND e.pos = d.pos AND d.degree > {NO_EDGE!r}
  LEFT JOIN deg o ON o.video_id = e.video_id AND o.seg = e.seg2 AND o.pos = e.pos2
  LEFT JOIN r{i - 1} r ON r.video_id = e.video_id AND r.seg = e.seg2 AND r.pos = e.pos2
  GROUP BY ALL)""")
    return ",\n".join(out)


_GAP = """'[ \\t\\r\\n,;:()"]+'"""

ORACLE_SUMMARIES = {
    "summary_emotions": f"""
WITH raw AS (
  SELECT conv_id AS video_id, turn AS seg, unnest(regexp_split_to_array(text, '[.!?\\n]+')) AS s,
         unnest(range(len(regexp_split_to_array(text, '[.!?\\n]+')))) AS pos
  FROM conversations WHERE role = 'assistant'),
sents AS (SELECT video_id, seg, pos, trim(translate(s, chr(9) || chr(13), '  '), ' ') AS sentence FROM raw),
terms AS (
  SELECT video_id, seg, pos, unnest(regexp_split_to_array(translate(sentence, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_GAP})) AS term
  FROM sents),
n AS (SELECT video_id, seg, pos, term, count(*)::DOUBLE AS n FROM terms WHERE term != '' GROUP BY ALL),
norm AS (SELECT video_id, seg, pos, sqrt(sum(n * n)) AS norm FROM n GROUP BY ALL),
v AS (SELECT n.*, n / norm AS w FROM n JOIN norm USING (video_id, seg, pos)),
edges AS (
  SELECT a.video_id, a.seg, a.pos, b.seg AS seg2, b.pos AS pos2, sum(a.w * b.w) AS w
  FROM v a JOIN v b ON a.video_id = b.video_id AND a.term = b.term AND (a.seg != b.seg OR a.pos != b.pos) GROUP BY ALL),
deg AS (
  SELECT n.video_id, n.seg, n.pos, coalesce(d.degree, 0) AS degree
  FROM norm n LEFT JOIN (SELECT video_id, seg, pos, sum(w) AS degree FROM edges GROUP BY ALL) d USING (video_id, seg, pos)),
{_rounds()},
placed AS (SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY round(rank, {PLACES}) DESC, seg, pos) AS place FROM r{ROUNDS}),
summed AS (
  SELECT video_id, string_agg(sentence, '. ' ORDER BY seg, pos) || '.' AS summary
  FROM placed JOIN sents USING (video_id, seg, pos) WHERE place <= {SENTENCES} GROUP BY video_id),
c AS (SELECT video_id, count(*) AS n_sentences FROM norm GROUP BY video_id),
top AS (SELECT video_id, n_sentences, summary, {length_top3('summary')} AS t FROM c JOIN summed USING (video_id))
SELECT video_id, n_sentences, summary,
  {', '.join(f"t[{i}].emotion AS summary_emotion{i}" for i in range(1, 4))},
  {', '.join(f"floor(t[{i}].conf * 1e6 + 0.5) / 1e6 AS summary_conf{i}" for i in range(1, 4))}
FROM top
""",
}
