"""DuckDB oracle SQL for the text queries (brute force: transcripts are
assembled first, every comment is paired with every chunk of its video)."""

from __future__ import annotations

from reverbkit.constants import CHUNK_OVERLAP, CHUNK_WORDS, EMOTIONS, SLANG
from reverbkit.plans.oracle import EMO_LIST, flat, fsum, r6, relation_cte
from reverbkit.plans.variants import COMMENT_VARIANTS, SLANG_VARIANTS, TRANSCRIPT_VARIANTS, wrap_sql

WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\pZ]"
NOT_WS = r"[^\s\x{0b}\x{1c}-\x{1f}\x{85}\pZ]"
TOK = r"[\pL\pN_]+|[^\pL\pN_]+"
AINT = r"(^|[^\pL\pN_])ain''t([^\pL\pN_]|$)"
STEP = CHUNK_WORDS - CHUNK_OVERLAP


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _map_sql(d: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"{_q(k)}: {_q(v)}" for k, v in d.items()) + "}"


def slang_map_sql() -> str:
    return _map_sql({k: v for k, v in SLANG.items() if k.replace("_", "").isalnum()})


# Emoji of the comment variants as code points and their expected names, written
# by hand (longer sequences first); independent of the engine's table.
EXPECTED_EMOJI = [
    ((0x2764, 0xFE0F, 0x200D, 0x1F525), ":heart_on_fire:"),
    ((0x1F468, 0x200D, 0x1F469, 0x200D, 0x1F467), ":family_man_woman_girl:"),
    ((0x1F64C, 0x1F3FF, 0x200D, 0x1F525), ":raising_hands_dark_skin_tone::fire:"),
    ((0x1F44D, 0x1F3FD), ":thumbs_up_medium_skin_tone:"),
    ((0x1F1EE, 0x1F1F3), ":india:"),
    ((0x1F1EF, 0x1F1F5), ":japan:"),
    ((0x31, 0xFE0F, 0x20E3), ":keycap_1:"),
    ((0x2764, 0xFE0F), ":red_heart:"),
    ((0x2B50,), ":star:"),
    ((0x23F0,), ":alarm_clock:"),
    ((0x1F7E2,), ":green_circle:"),
    ((0x1F601,), ":beaming_face_with_smiling_eyes:"),
    ((0x1F4AF,), ":hundred_points:"),
    ((0x1F3C6,), ":trophy:"),
    ((0x1F389,), ":party_popper:"),
    ((0x1F525,), ":fire:"),
    ((0x1F602,), ":face_with_tears_of_joy:"),
]


def emoji_sql(x: str) -> str:
    for points, name in EXPECTED_EMOJI:
        x = f"replace({x}, {' || '.join(f'chr({p})' for p in points)}, {_q(name)})"
    return x


def slang_sql(x: str) -> str:
    y = f"regexp_replace(regexp_replace({x}, '{AINT}', '\\1is not\\2', 'g'), '{AINT}', '\\1is not\\2', 'g')"
    return (f"array_to_string(list_transform(regexp_extract_all({y}, '{TOK}'), "
            f"lambda w: coalesce(({slang_map_sql()})[w], w)), '')")


def clean_transcript_sql(x: str) -> str:
    t = f"regexp_replace({x}, '\\[.*?\\]', '', 'g')"
    t = f"regexp_replace({t}, '\\r\\n|\\n', ' ', 'g')"
    t = f"regexp_replace({t}, '{WS}+', ' ', 'g')"
    t = f"regexp_replace({t}, '[^\\pL\\pN_\\s\\x{{0b}}\\x{{1c}}-\\x{{1f}}\\x{{85}}\\pZ.,!?-]', '', 'g')"
    return f"coalesce(trim({t}), '')"


def words_sql(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS}+'), lambda s: s <> '')"


def comments_cte() -> str:
    """CTEs ending in ``ccomments(video_id, comment_pos, comment)``."""
    raw = wrap_sql("text", f"(conv_id + turn) % {len(COMMENT_VARIANTS)}", COMMENT_VARIANTS)
    return f"""
cc0 AS (SELECT conv_id AS video_id, turn AS comment_pos, {raw} AS raw FROM conversations WHERE role = 'user'),
cc1 AS (SELECT *, trim(regexp_replace(regexp_replace(raw, '\\r\\n|\\n', ' ', 'g'), '{WS}+', ' ', 'g')) AS x FROM cc0),
cc2 AS (SELECT *, starts_with(x, '@') AS is_reply,
               regexp_replace(x, 'http{NOT_WS}+|www\\.{NOT_WS}+', '', 'g') AS y FROM cc1),
cc3 AS (SELECT *, lower({emoji_sql('y')}) AS y2 FROM cc2),
cc5 AS (SELECT *, {slang_sql('y2')} AS y4 FROM cc3),
cc6 AS (SELECT *, trim(regexp_replace(regexp_replace(y4, '[^a-zA-Z0-9\\s\\x{{0b}}\\x{{1c}}-\\x{{1f}}\\x{{85}}\\pZ:]', '', 'g'),
               '{WS}+', ' ', 'g')) AS y5 FROM cc5),
ccomments AS (
  SELECT video_id, comment_pos, y5 AS comment FROM cc6
  WHERE raw IS NOT NULL AND raw <> '' AND NOT is_reply AND y5 <> ''
)"""


def seg_chunks_cte() -> str:
    """CTEs ending in ``kchunks(video_id, chunk_index, chunk)`` built from the
    assembled, cleaned transcript of each conversation."""
    return f"""
asm AS (
  SELECT conv_id AS video_id, string_agg(text || chr(10), '' ORDER BY turn) AS transcript, count(*) AS n_segments
  FROM conversations WHERE role = 'assistant' GROUP BY conv_id
),
aw AS (SELECT video_id, {words_sql(clean_transcript_sql('transcript'))} AS w FROM asm),
kst AS (SELECT video_id, w, unnest(range(0, len(w), {STEP})) AS st FROM aw),
kchunks AS (
  SELECT video_id, CAST(st // {STEP} + 1 AS INTEGER) AS chunk_index, array_to_string(w[st + 1:st + {CHUNK_WORDS}], ' ') AS chunk
  FROM kst
)"""


def tfidf_cte() -> str:
    """CTEs ending in ``tbest``: the chunk of the highest TF-IDF cosine for
    each distinct comment, over all pairs of a video."""
    return comments_cte() + "," + seg_chunks_cte() + """,
dc AS (SELECT video_id, comment, min(comment_pos) AS comment_pos FROM ccomments GROUP BY video_id, comment),
kt AS (SELECT video_id, chunk_index, unnest(regexp_extract_all(lower(chunk), '[\\pL\\pN]+')) AS term FROM kchunks),
ktf AS (SELECT video_id, chunk_index, term, count(*) AS tf FROM kt GROUP BY ALL),
nkc AS (SELECT video_id, count(*) AS nk FROM kchunks GROUP BY video_id),
idf AS (
  SELECT f.video_id, f.term, ln((1 + n.nk) / (1 + f.df)) AS idf
  FROM (SELECT video_id, term, count(*) AS df FROM ktf GROUP BY ALL) f JOIN nkc n USING (video_id)),
kw AS (SELECT k.video_id, k.chunk_index, k.term, k.tf * i.idf AS w FROM ktf k JOIN idf i USING (video_id, term)),
kn AS (SELECT video_id, chunk_index, sqrt(sum(w * w)) AS nrm FROM kw GROUP BY ALL),
ct AS (SELECT video_id, comment_pos, unnest(regexp_extract_all(lower(comment), '[\\pL\\pN]+')) AS term FROM dc),
ctf AS (SELECT video_id, comment_pos, term, count(*) AS tf FROM ct GROUP BY ALL),
cw AS (SELECT c.video_id, c.comment_pos, c.term, c.tf * i.idf AS w FROM ctf c JOIN idf i USING (video_id, term)),
cn AS (SELECT video_id, comment_pos, sqrt(sum(w * w)) AS nrm FROM cw GROUP BY ALL),
dt AS (
  SELECT c.video_id, c.comment_pos, k.chunk_index, sum(c.w * k.w) AS d
  FROM cw c JOIN kw k ON c.video_id = k.video_id AND c.term = k.term GROUP BY ALL),
pairs AS (
  SELECT c.video_id, c.comment_pos, k.chunk_index,
    CASE WHEN coalesce(cn.nrm, 0) * coalesce(kn.nrm, 0) > 0
         THEN coalesce(dt.d, 0) / (cn.nrm * kn.nrm) ELSE 0.0 END AS sim
  FROM dc c JOIN kchunks k ON c.video_id = k.video_id
  LEFT JOIN cn ON cn.video_id = c.video_id AND cn.comment_pos = c.comment_pos
  LEFT JOIN kn ON kn.video_id = k.video_id AND kn.chunk_index = k.chunk_index
  LEFT JOIN dt ON dt.video_id = c.video_id AND dt.comment_pos = c.comment_pos AND dt.chunk_index = k.chunk_index),
tbest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY video_id, comment_pos
                                 ORDER BY floor(sim * 1e12 + 0.5) / 1e12 DESC, chunk_index) AS rn FROM pairs)
  WHERE rn = 1)"""


ORACLE_TEXT: dict[str, str] = {}

ORACLE_TEXT["clean_comments"] = "WITH " + comments_cte() + """
SELECT video_id, comment_pos, comment FROM ccomments
"""

ORACLE_TEXT["distinct_comments"] = "WITH " + comments_cte() + """
SELECT video_id, comment, min(comment_pos) AS comment_pos, count(*) AS n_copies FROM ccomments GROUP BY video_id, comment
"""

ORACLE_TEXT["slang_expand"] = f"""
SELECT doc_id, {slang_sql(f"lower({wrap_sql('text', 'doc_id % 4', SLANG_VARIANTS)})")} AS expanded FROM documents
"""

_DOCS = f"SELECT doc_id AS video_id, {wrap_sql('text', 'doc_id % 5', TRANSCRIPT_VARIANTS)} AS transcript FROM documents"

ORACLE_TEXT["clean_transcripts"] = f"""
SELECT video_id, {clean_transcript_sql('transcript')} AS transcript FROM ({_DOCS})
"""

ORACLE_TEXT["chunk_transcripts"] = f"""
WITH d AS ({_DOCS}),
dw AS (SELECT video_id, {words_sql(clean_transcript_sql('transcript'))} AS w FROM d),
st AS (SELECT video_id, w, unnest(range(0, len(w), {STEP})) AS s FROM dw),
ch AS (SELECT video_id, CAST(s // {STEP} + 1 AS INTEGER) AS chunk_index, array_to_string(w[s + 1:s + {CHUNK_WORDS}], ' ') AS chunk FROM st)
SELECT video_id, chunk_index, chunk, CAST(len({words_sql('chunk')}) AS INTEGER) AS n_words FROM ch
"""

ORACLE_TEXT["transcript_assembly"] = """
SELECT conv_id AS video_id, count(*) AS n_segments, string_agg(text || chr(10), '' ORDER BY turn) AS transcript
FROM conversations WHERE role = 'assistant' GROUP BY conv_id
"""

ORACLE_TEXT["segment_chunks"] = "WITH " + seg_chunks_cte() + """
SELECT video_id, chunk_index, chunk FROM kchunks
"""

ORACLE_TEXT["pair_counts"] = "WITH " + comments_cte() + "," + seg_chunks_cte() + """,
nk AS (SELECT video_id, count(*) AS n_chunks FROM kchunks GROUP BY video_id),
nc AS (SELECT video_id, count(*) AS n_comments FROM ccomments GROUP BY video_id)
SELECT video_id, n_chunks, n_comments, n_chunks * n_comments AS n_pairs FROM nk JOIN nc USING (video_id)
"""

ORACLE_TEXT["rejected_videos"] = "WITH " + comments_cte() + "," + seg_chunks_cte() + """,
vids AS (SELECT DISTINCT conv_id AS video_id FROM conversations),
nw AS (SELECT video_id, len(w) AS n_words FROM aw),
nc AS (SELECT video_id, count(*) AS n_comments FROM ccomments GROUP BY video_id),
j AS (
  SELECT video_id,
    CASE WHEN coalesce(n_words, 0) = 0 THEN 'no_transcript'
         WHEN coalesce(n_comments, 0) = 0 THEN 'no_comments' END AS reason
  FROM vids LEFT JOIN nw USING (video_id) LEFT JOIN nc USING (video_id))
SELECT video_id, reason FROM j WHERE reason IS NOT NULL
"""

ORACLE_TEXT["tfidf_nearest_chunk"] = "WITH " + tfidf_cte() + f"""
SELECT video_id, comment_pos, chunk_index, {r6('sim')} AS similarity FROM tbest
"""


def length_top3(text: str) -> str:
    """Top-3 emotions of the scorer by text length (``flow_queries.LengthScorer``)."""
    ex = f"list_transform(range(1, {len(EMOTIONS) + 1}), lambda i: exp(CAST((length({text}) * i) % 7 AS DOUBLE) - \
        list_max(list_transform(range(1, {len(EMOTIONS) + 1}), lambda j: CAST((length({text}) * j) % 7 AS DOUBLE)))))"
    ranked = f"list_sort(list_transform({ex}, lambda x, i: {{'neg': -x / {fsum(ex)}, 'idx': i - 1}}))[1:3]"
    return f"list_transform({ranked}, lambda s: {{'emotion': {EMO_LIST}[s.idx + 1], 'conf': -s.neg, 'idx': s.idx}})"


_FLOW = "WITH " + tfidf_cte() + f""",
best AS (
  SELECT b.video_id, b.comment_pos, d.comment, k.chunk, {length_top3('d.comment')} AS ctop, {length_top3('k.chunk')} AS ttop
  FROM tbest b JOIN dc d ON b.video_id = d.video_id AND b.comment_pos = d.comment_pos
  JOIN kchunks k ON b.video_id = k.video_id AND b.chunk_index = k.chunk_index),
""" + relation_cte()

ORACLE_TEXT["flow_predictions"] = _FLOW + f"""
SELECT video_id, comment_pos, comment, chunk AS transcript_chunk, {flat('ctop', 'comment')}, {flat('ttop', 'transcript')} FROM flow
"""

ORACLE_TEXT["flow_relations"] = _FLOW + f"""
SELECT video_id, comment_pos, final_emotion, {r6('wrs')} AS wrs, ecf,
  {', '.join(f"{r6(f'ces[list_position(list_transform(ctop, lambda c: c.emotion), {chr(39)}{e}{chr(39)})]')} AS {e.lower()}" for e in EMOTIONS)}
FROM flow
"""

ORACLE_TEXT["flow_report"] = _FLOW + """,
vids AS (SELECT DISTINCT conv_id AS video_id FROM conversations),
sc AS (SELECT video_id, sentiment AS v, count(*) AS n FROM flow GROUP BY ALL),
ec AS (SELECT video_id, ctop[1].emotion AS v, count(*) AS n FROM flow GROUP BY ALL),
sm AS (SELECT video_id, arg_min(v, {'n': -n, 'v': v}) AS v FROM sc GROUP BY video_id),
em AS (SELECT video_id, arg_min(v, {'n': -n, 'v': v}) AS v FROM ec GROUP BY video_id),
nc AS (SELECT video_id, count(*) AS n FROM flow GROUP BY video_id)
SELECT vids.video_id, coalesce(nc.n, 0) AS n_comments,
       coalesce(sm.v, 'N/A') AS overall_sentiment, coalesce(em.v, 'N/A') AS overall_emotion
FROM vids LEFT JOIN nc USING (video_id) LEFT JOIN sm USING (video_id) LEFT JOIN em USING (video_id)
"""

