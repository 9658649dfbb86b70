"""The registered queries of this package, over whole tables, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortica.llm import (
    adaptive_scan, byte_network, cap_filters, conversation_repair, key_index, pair_ranking, paragraph_bands, periodic_runs, piece_codec,
    prefix_join, secret_scan, soft_mixing, uniform_threshold,
)
from cohortica.llm.common import held_out, table

ORACLES: dict = {}


def op1_cap_filters(spark, sf_dir):
    return cap_filters.link_vectors(table(spark, sf_dir, "embeddings"))


# Shares of tokens that the mixing queries aim at.
WEIGHTS = {"good": 0.9, "poor": 0.08, "toxic": 0.02}


def op2_soft_mixing(spark, sf_dir):
    return soft_mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), WEIGHTS)


def op3_adaptive_scan(spark, sf_dir):
    return adaptive_scan.nearest(table(spark, sf_dir, "embeddings"))


def op4_byte_network(spark, sf_dir):
    docs, out = table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 4, 2)
    network = byte_network.train(docs.where(~out))
    found = byte_network.predict(docs, network)
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")


def op5_paragraph_bands(spark, sf_dir):
    return paragraph_bands.repeats(table(spark, sf_dir, "documents"))


def op6_pair_ranking(spark, sf_dir):
    docs, out = table(spark, sf_dir, "documents"), held_out(F.col("doc_id"), 5, 0)
    ranker = pair_ranking.train(docs, table(spark, sf_dir, "labels").where(~out))
    return pair_ranking.score(docs, ranker).select("doc_id", out.alias("held_out"), "score", "predicted")


def op7_key_index(spark, sf_dir):
    import public_tokenizers

    return key_index.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_prefix_join(spark, sf_dir):
    return prefix_join.join(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark, sf_dir):
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op10_piece_codec(spark, sf_dir):
    import public_tokenizers

    return piece_codec.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op11_periodic_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    texts = docs.select("doc_id", periodic_runs.looped(F.col("text"), F.col("doc_id")).alias("text"))
    return periodic_runs.digests(periodic_runs.periodic_runs(texts))


def op12_uniform_threshold(spark, sf_dir):
    return uniform_threshold.top(table(spark, sf_dir, "embeddings"))


def op13_conversation_repair(spark, sf_dir):
    return conversation_repair.audit_report(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_cap_filters, op2_soft_mixing, op3_adaptive_scan, op4_byte_network, op5_paragraph_bands, op6_pair_ranking, op7_key_index,
    op8_prefix_join, op9_secret_scan, op10_piece_codec, op11_periodic_runs, op12_uniform_threshold, op13_conversation_repair,
)}

ORACLES["op1_cap_filters"] = """
WITH RECURSIVE ok AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
)
SELECT e.vec_id, coalesce(n, 0) AS n_links, m AS component_id, e.vec_id = m AS kept
FROM embeddings e JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) c ON c.a = e.vec_id
LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) d ON d.a = e.vec_id
"""

ORACLES["op8_prefix_join"] = """
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(greatest(len(w) - 4, 1)), lambda i: array_to_string(w[i + 1:i + 5], ' '))) AS s
  FROM split WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS met FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * met >= 75 * (x.n + y.n - met)
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM documents d LEFT JOIN sizes ON sizes.doc_id = d.doc_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = d.doc_id
"""

ORACLES["op12_uniform_threshold"] = """
WITH rows AS (
  SELECT vec_id AS id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.id AS query_id, c.id AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM rows q JOIN rows c ON c.id <> q.id AND len(c.v) = len(q.v) WHERE q.id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""

# Costs to the end of each conversation row by row from its last one; per state the least (cost, letters), with the turns.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
    string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
    lambda ch: [ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
  lambda c, b: CASE WHEN xor(c, b) % 2 = 1 THEN xor(xor(c, b) // 2, 3988292384) ELSE xor(c, b) // 2 END), 4294967295::BIGINT)"""


def _way(cost: str, letter: str, to: int, line: str | None) -> str:
    turns = f"w.v{to}.t" if line is None else f"list_prepend({line}, w.v{to}.t)"
    return f"{{'c': w.v{to}.c + {cost}, 'a': '{letter}' || w.v{to}.a, 't': {turns}}}"


def _spent(state: int) -> str:
    """The least way to take a row from ``state``; an impossible one has a cost beyond all others."""
    new = "'assistant:' || r.text" if state == 2 else "'user:' || r.text"
    to = 3 if state == 2 else 2
    ways = [_way("4", "D", state, None), _way("3 + r.cut + r.must", "R", to, new)]
    for role, move in (("s", {0: 1}), ("u", {0: 2, 1: 2, 3: 2}), ("a", {2: 3})):
        if state in move:
            ways.append(_way(f"r.cut + r.must + CASE WHEN left(r.role, 1) = '{role}' THEN 0 ELSE 1000000000 END", "K", move[state], "r.role || ':' || r.text"))
    return f"least({', '.join(ways)})"


def _inserted(state: int, other: str, role: str) -> str:
    return f"least(s{state}, {{'c': {other}.c + 3, 'a': 'I' || {other}.a, 't': list_prepend('{role}:', {other}.t)}}) AS v{state}"


ORACLES["op13_conversation_repair"] = f"""
WITH RECURSIVE hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC32} % 20 AS d FROM conversations
), hurt AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
    CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM hashed JOIN (SELECT unnest([1, 2]) AS copy) ON copy = 1 OR d = 3 WHERE d <> 0
), placed AS (
  SELECT *, coalesce(conv_id::VARCHAR, '') AS key, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS core FROM hurt
), judged AS (
  SELECT *, core = '' AS blank, core <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 AS duplicate,
    left(lag(role) OVER (PARTITION BY conv_id ORDER BY k), 1) || left(role, 1) AS pair FROM placed
), marked AS (
  SELECT *, NOT blank AND NOT duplicate AND right(core, 1) NOT IN ('.', '!', '?') AS truncated FROM judged
), rows AS (
  SELECT *, CASE WHEN truncated THEN 3 ELSE 0 END AS cut, CASE WHEN blank OR duplicate THEN 1000000000 ELSE 0 END AS must FROM marked
), walk AS (
  SELECT key, max(k) + 1 AS k, {{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}} AS v0, {{'c': 6::BIGINT, 'a': 'II', 't': ['user:', 'assistant:']}} AS v1,
    {{'c': 3::BIGINT, 'a': 'I', 't': ['assistant:']}} AS v2, {{'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]}} AS v3 FROM rows GROUP BY key
  UNION ALL
  SELECT key, k, {_inserted(0, 'v2', 'user')}, {_inserted(1, 'v2', 'user')}, v2, v3 FROM (
    SELECT key, k, s0, s1, {_inserted(2, 's3', 'assistant')}, {_inserted(3, 's2', 'user')} FROM (
      SELECT w.key, r.k, {', '.join(f'{_spent(s)} AS s{s}' for s in range(4))} FROM walk w JOIN rows r ON r.key = w.key AND r.k = w.k - 1))
), counts AS (
  SELECT key, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(duplicate) AS duplicate,
    count_if(truncated) AS truncated, count_if(pair NOT IN ('su', 'ua', 'au')) AS illegal FROM rows GROUP BY key
), ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(v0.c, 0)::BIGINT AS cost,
  coalesce(v0.a, '') AS audit, sha256(coalesce(array_to_string(v0.t, chr(10)), '')) AS repaired_sha256
FROM ids LEFT JOIN counts ON counts.key = coalesce(conv_id::VARCHAR, '') LEFT JOIN walk ON walk.key = counts.key AND walk.k = 1
"""
