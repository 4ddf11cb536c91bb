"""DuckDB SQL twins of the registered queries (same column names)."""

# squared L2 of two float lists in double precision
_D2 = ("list_sum(list_transform(range(1, len({a}) + 1), "
       "lambda i: ({a}[i]::DOUBLE - {b}[i]::DOUBLE) * ({a}[i]::DOUBLE - {b}[i]::DOUBLE)))")

ORACLE_SQL = {
    "knn_flat": f"""
WITH d AS (
  SELECT q.vec_id AS q_id, e.vec_id, {_D2.format(a='q.embedding', b='e.embedding')} AS d2
  FROM embeddings q, embeddings e),
r AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY round(d2, 9), vec_id) AS rk
      FROM d)
SELECT q_id, vec_id, CAST(rk AS INTEGER) AS rank, round(d2, 6) AS d2,
       round(1 - d2 / 2, 6) AS similarity
FROM r WHERE rk <= 5
""",
}


# ------------------------------------------------------------------ fragments
def _words(x: str) -> str:
    return rf"list_filter(regexp_split_to_array({x}, '\s+'), lambda w: w <> '')"


def _lwords(x: str) -> str:
    return _words(f"lower({x})")


def _bucket(w: str, dim: int = 64) -> str:
    return f"((('0x' || substr(md5({w}), 1, 4))::INTEGER) % {dim})"


def _hash_embed_cte(name: str, src: str, key_cols: str, text: str, dim: int = 64) -> str:
    """CTEs ending in ``name``: key_cols + e (unit hash vector)."""
    return f"""
{name}_b AS (SELECT {key_cols}, list_transform({_lwords(text)}, lambda w: {_bucket('w', dim)}) AS bk
             FROM {src}),
{name}_c AS (SELECT {key_cols},
                    list_transform(range({dim}), lambda b: len(list_filter(bk, lambda x: x = b))::DOUBLE) AS cnt
             FROM {name}_b),
{name}_n AS (SELECT *, sqrt(list_sum(list_transform(cnt, lambda x: x * x))) AS nrm FROM {name}_c),
{name} AS (SELECT {key_cols},
                  list_transform(cnt, lambda x: CASE WHEN nrm > 0 THEN x / nrm ELSE x END) AS e
           FROM {name}_n)"""


def _chunks_cte(name: str, size: int, extra: str = ", source", src: str = "documents") -> str:
    return f"""
{name}_w AS (SELECT doc_id{extra}, {_words('text')} AS ws FROM {src}),
{name}_a AS (SELECT doc_id{extra},
                    list_transform(range(0, len(ws), {size}),
                                   lambda i: array_to_string(ws[i + 1:i + {size}], ' ')) AS cs
             FROM {name}_w),
{name} AS (SELECT * FROM (
             SELECT doc_id{extra}, unnest(cs) AS text,
                    CAST(generate_subscripts(cs, 1) - 1 AS INTEGER) AS chunk_id
             FROM {name}_a) WHERE text <> '')"""


_VOCAB_CTES = f"""
occ_w AS (SELECT doc_id, {_words('text')} AS ws FROM documents),
occ AS (SELECT doc_id, unnest(ws) AS token, generate_subscripts(ws, 1) AS pos FROM occ_w),
voc AS (SELECT token, CAST(row_number() OVER (ORDER BY n DESC, token) AS INTEGER) AS id, n
        FROM (SELECT token, count(*) AS n FROM occ GROUP BY token)),
enc AS (SELECT d.doc_id, coalesce(e.ids, []::INTEGER[]) AS input_ids
        FROM documents d LEFT JOIN (
          SELECT doc_id, list(id ORDER BY pos) AS ids FROM occ JOIN voc USING (token)
          GROUP BY doc_id) e USING (doc_id))"""

_WINDOWS_CTES = _VOCAB_CTES + """,
win AS (SELECT doc_id, list_filter(list_transform(range(0, len(input_ids), 96),
                                                  lambda i: input_ids[i + 1:i + 128]),
                                   lambda w: len(w) >= 10) AS ws FROM enc),
tw AS (SELECT doc_id, unnest(ws) AS input_ids,
              CAST(generate_subscripts(ws, 1) - 1 AS INTEGER) AS chunk_id FROM win)"""

# search store: 64-word chunks of documents, 64-bucket hash vectors, top k
def _search_ctes(k: int) -> str:
    return ("WITH " + _chunks_cte("ch", 64).strip() + "," +
                _hash_embed_cte("ce", "ch", "doc_id, chunk_id, source, text", "text") + "," +
                _hash_embed_cte("qe", "(SELECT item_id AS q_id, text AS question FROM benchmark)",
                                "q_id, question", "question") + f""",
dd AS (SELECT q.q_id, q.question, c.doc_id, c.chunk_id, c.source, c.text,
              {_D2.format(a='q.e', b='c.e')} AS d2 FROM qe q, ce c),
rr AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY round(d2, 9), doc_id, chunk_id) AS rk
       FROM dd),
hits AS (SELECT q_id, question, doc_id, chunk_id, source, text, d2, 1 - d2 / 2 AS similarity,
                CAST(rk AS INTEGER) AS rank FROM rr WHERE rk <= {k}),
ov AS (SELECT *, CAST(len(list_intersect({_lwords('question')}, {_lwords('text')})) AS INTEGER) AS overlap
       FROM hits),
sc AS (SELECT *, similarity * (1 + 0.1 * overlap) AS score FROM ov),
rer AS (SELECT * EXCLUDE (rank), rank AS prev_rank,
               CAST(row_number() OVER (PARTITION BY q_id ORDER BY round(score, 9) DESC, rank)
                    AS INTEGER) AS rank FROM sc),
ctx AS (SELECT q_id, string_agg('[Document ' || rank || ']: ' || text, chr(10) || chr(10)
                                ORDER BY rank) AS context FROM rer GROUP BY q_id),
qctx AS (SELECT b.item_id AS q_id, b.text AS question, coalesce(c.context, '') AS context
         FROM benchmark b LEFT JOIN ctx c ON c.q_id = b.item_id)
""")


_SEARCH_CTES = _search_ctes(5)

# The prompt wording (see operators/prompts.py).
_RAG_HEAD = ("'You are a helpful assistant. Answer the question based on the provided context.' "
             "|| chr(10) || 'If the context doesn''t contain relevant information, say \"I don''t "
             "have enough information to answer this question.\"' || chr(10) || chr(10) || "
             "'Context:' || chr(10)")
_NL2 = "chr(10) || chr(10)"


def _rag_prompt(q: str, c: str) -> str:
    return f"({_RAG_HEAD} || {c} || {_NL2} || 'Question: ' || {q} || {_NL2} || 'Answer:')"


def _plain_prompt(q: str) -> str:
    return f"('Question: ' || {q} || {_NL2} || 'Answer:')"


_EXTRACT = ("'Extract knowledge triples (subject, relation, object) from the text below. "
            "Return ONLY a list of Python tuples like [(subject, relation, object), ...].'")


def _round_list(x: str) -> str:
    return f"list_transform({x}, lambda x: round(x, 6))"


ORACLE_SQL.update({
    "word_chunks": "WITH " + _chunks_cte("wc", 1500, "").strip() + f"""
SELECT doc_id, chunk_id, CAST(len({_words('text')}) AS INTEGER) AS n_words,
       CAST(length(text) AS INTEGER) AS n_chars, text FROM wc""",
    "vocab_build": "WITH " + _VOCAB_CTES.strip() + "\nSELECT token, id, n FROM voc",
    "vocab_encode": "WITH " + _VOCAB_CTES.strip() +
    "\nSELECT doc_id, CAST(len(input_ids) AS INTEGER) AS n_tokens, input_ids FROM enc",
    "token_windows": "WITH " + _WINDOWS_CTES.strip() +
    "\nSELECT doc_id, chunk_id, CAST(len(input_ids) AS INTEGER) AS n_tokens, input_ids FROM tw",
    "token_windows_padded": "WITH " + _WINDOWS_CTES.strip() + """,
pad AS (SELECT doc_id, chunk_id,
               (input_ids || list_transform(range(greatest(128 - len(input_ids), 0)), lambda x: 0))
               ::INTEGER[] AS input_ids FROM tw)
SELECT doc_id, chunk_id, input_ids, input_ids AS labels,
       list_transform(input_ids, lambda x: 1)::INTEGER[] AS attention_mask FROM pad""",
    "truncate_tokens": "WITH " + _VOCAB_CTES.strip() + """
SELECT doc_id, input_ids[1:512] AS input_ids, CAST(len(input_ids[1:512]) AS INTEGER) AS n_tokens
FROM enc""",
    "hash_embed": "WITH " + _hash_embed_cte("he", "documents", "doc_id", "text").strip() +
    f"\nSELECT doc_id, {_round_list('e')} AS embedding FROM he",
    "l2_normalize": """
WITH n AS (SELECT vec_id, embedding,
                  sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS nrm
           FROM embeddings)
SELECT vec_id, list_transform(embedding, lambda x: round(CASE WHEN nrm > 0 THEN x::DOUBLE / nrm
                                                         ELSE x::DOUBLE END, 6)) AS embedding
FROM n""",
    "vector_norms": """
SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6)
       AS norm FROM embeddings""",
    "mean_pool": """
WITH t AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS d
           FROM embeddings),
s AS (SELECT label, d, sum(x) / greatest(count(*)::DOUBLE, 1e-9) AS v FROM t GROUP BY label, d)
SELECT label, list(round(v, 6) ORDER BY d) AS pooled FROM s GROUP BY label""",
    "knn_similarity_filter": f"""
WITH d AS (
  SELECT q.vec_id AS q_id, e.vec_id, {_D2.format(a='q.embedding', b='e.embedding')} AS d2
  FROM embeddings q, embeddings e),
r AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY round(d2, 9), vec_id) AS rk
      FROM d)
SELECT q_id, vec_id, CAST(rk AS INTEGER) AS rank, round(1 - d2 / 2, 6) AS similarity
FROM r WHERE rk <= 5 AND round(1 - d2 / 2, 9) >= 0.35 AND vec_id <> q_id""",
    "search_text": _SEARCH_CTES + """
SELECT q_id, rank, doc_id, chunk_id, source, round(similarity, 6) AS similarity FROM hits""",
    "search_rerank": _SEARCH_CTES + """
SELECT q_id, rank, prev_rank, doc_id, chunk_id, overlap, round(similarity, 6) AS similarity,
       round(score, 6) AS score FROM rer""",
    "rerank_overlap": _SEARCH_CTES + f"""
SELECT q_id, doc_id, chunk_id,
       CAST(len(list_distinct({_lwords('question')})) AS INTEGER) AS n_query_terms, overlap
FROM ov""",
    "rag_context": _SEARCH_CTES + "SELECT q_id, context FROM qctx",
    "rag_prompt": _SEARCH_CTES + f"SELECT q_id, {_rag_prompt('question', 'context')} AS prompt FROM qctx",
    "plain_prompt": f"SELECT item_id AS q_id, {_plain_prompt('text')} AS prompt FROM benchmark",
    "extract_prompt": f"""
SELECT doc_id, ({_EXTRACT} || {_NL2} || 'Text: ' || text) AS prompt FROM documents""",
    "retrieved_nested": _SEARCH_CTES + """
SELECT q_id, CAST(count(*) AS INTEGER) AS n_chunks,
       string_agg(concat_ws('|', rank::VARCHAR, source, chunk_id::VARCHAR,
                            printf('%.6f', round(score, 6)), md5(text)), ';' ORDER BY rank) AS retrieved
FROM rer GROUP BY q_id""",
})


_SPLIT_EXACT = """
SELECT doc_id, CASE WHEN i < floor(n * 0.9) THEN 'train' ELSE 'eval' END AS split
FROM (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) - 1 AS i,
             count(*) OVER () AS n FROM documents)"""
_SPLIT_HASH = """
SELECT doc_id, CASE WHEN ('0x' || substr(md5('42:' || doc_id), 1, 8))::BIGINT / 4294967296.0 < 0.9
                    THEN 'train' ELSE 'eval' END AS split FROM documents"""
_WS_CHARS = "(' ' || chr(10) || chr(9) || chr(13) || chr(11) || chr(12))"

ORACLE_SQL.update({
    "split_exact": _SPLIT_EXACT,
    "split_hash": _SPLIT_HASH,
    "split_counts": f"""
SELECT 'exact' AS mode, split, count(*) AS n, sum(doc_id)::BIGINT AS sum_ids FROM ({_SPLIT_EXACT}) GROUP BY split
UNION ALL
SELECT 'fraction' AS mode, split, count(*) AS n, sum(doc_id)::BIGINT AS sum_ids FROM ({_SPLIT_HASH}) GROUP BY split""",
    "incremental_skip": """
SELECT d.doc_id, d.n_chars FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "skip_counts": """
SELECT count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)) AS processed,
       count(*) FILTER (WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)) AS skipped
FROM documents d""",
    "page_concat": """
SELECT conv_id, CAST(count(*) AS INTEGER) AS n_pages,
       CAST(length(string_agg(text, '' ORDER BY turn)) AS INTEGER) AS n_chars,
       string_agg(text, '' ORDER BY turn) AS text
FROM conversations GROUP BY conv_id""",
    "stem_and_names": r"""
WITH b AS (SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS base FROM pages)
SELECT page_id, base, regexp_extract(base, '^(\.*[^.].*?|\.*)(\.[^.]*)?$', 1) AS stem,
       replace(base || '.txt', '.txt', '_' || page_id || '.jsonl') AS window_name FROM b""",
    "metadata_merge": "WITH " + _chunks_cte("mc", 1500, ", source, lang").strip() + """
SELECT doc_id, chunk_id, coalesce(source, 'unknown') AS source, lang, chunk_id AS meta_chunk_id
FROM mc""",
    "metadata_json": "WITH " + _chunks_cte("mc", 1500, ", source, lang").strip() + """
SELECT doc_id, chunk_id, chunk_id AS meta_chunk_id, coalesce(source, 'unknown') AS source,
       CAST(length(text) AS INTEGER) AS n_chars, md5(text) AS text_md5 FROM mc""",
    "text_scan": """
SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars, md5(text) AS text_md5 FROM documents""",
    "ingest_stream": "SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars FROM documents",
    "answer_word_counts": f"""
SELECT conv_id, turn, CAST(len({_words('text')}) AS INTEGER) AS n_words,
       round(CASE WHEN len({_words('text')}) > 0
                  THEN length(text)::DOUBLE / len({_words('text')}) ELSE 0 END, 6) AS time_per_token
FROM conversations WHERE role = 'assistant'""",
    "strip_echo": f"""
WITH g AS (SELECT conv_id, turn, coalesce(lag(text) OVER (PARTITION BY conv_id ORDER BY turn), '') AS prompt,
                  text FROM conversations),
o AS (SELECT conv_id, turn, prompt, prompt || ' ' || text AS output FROM g)
SELECT conv_id, turn,
       CASE WHEN starts_with(output, prompt)
            THEN trim(substr(output, length(prompt) + 1), {_WS_CHARS}) ELSE output END AS answer
FROM o""",
})


def _stub_answer(prompt: str) -> str:
    """SQL twin of the DigestExtract stub after the echo is stripped."""
    tail = f"substr({prompt}, strpos({prompt}, 'Context:' || chr(10)) + 9)"
    tail = f"CASE WHEN strpos({prompt}, 'Context:' || chr(10)) > 0 THEN {tail} ELSE {prompt} END"
    return _digest_answer(tail)


def _digest_answer(tail: str) -> str:
    ws = f"({_words(tail)})"
    return (f"trim(md5(array_to_string({ws}, ' ')) || ' ' || len({ws}) || ' ' || "
            f"array_to_string({ws}[greatest(len({ws}) - 7, 1):len({ws})], ' '))")


_GRID = _search_ctes(7) + f""",
kk AS (SELECT * FROM (VALUES (3), (5), (7)) t(k)),
rb AS (SELECT * FROM (VALUES (false), (true)) t(rerank)),
g AS (SELECT sc.*, kk.k, rb.rerank FROM sc, kk, rb WHERE sc.rank <= kk.k),
gp AS (SELECT *, row_number() OVER (PARTITION BY q_id, k, rerank
                                    ORDER BY CASE WHEN rerank THEN -round(score, 9) ELSE 0 END, rank) AS pos
       FROM g),
gc AS (SELECT q_id, k, rerank, string_agg('[Document ' || pos || ']: ' || text, {_NL2} ORDER BY pos)
              AS context FROM gp GROUP BY q_id, k, rerank),
cells AS (SELECT b.item_id AS q_id, b.text AS question, kk.k, rb.rerank,
                 {_rag_prompt('b.text', "coalesce(gc.context, '')")} AS prompt
          FROM benchmark b CROSS JOIN kk CROSS JOIN rb
          LEFT JOIN gc ON gc.q_id = b.item_id AND gc.k = kk.k AND gc.rerank = rb.rerank),
ans AS (SELECT q_id, k, rerank, {_stub_answer('prompt')} AS answer FROM cells)
"""

_ANSWERS = _SEARCH_CTES + f""",
ra AS (SELECT q_id, question, {_rag_prompt('question', 'context')} AS prompt FROM qctx),
rans AS (SELECT q_id, question, {_stub_answer('prompt')} AS answer FROM ra)
"""

_PPL = "WITH " + f"""
sp AS ({_SPLIT_HASH}),
dsp AS (SELECT d.*, sp.split FROM documents d JOIN sp USING (doc_id)),
tr AS (SELECT unnest({_lwords('text')}) AS token FROM dsp WHERE split = 'train'),
cnt AS (SELECT token, count(*) AS c FROM tr GROUP BY token),
st AS (SELECT sum(c) AS nn, count(*) AS vv FROM cnt),
evd AS (SELECT * FROM dsp WHERE split = 'eval'),""" + _chunks_cte("ev", 1500, "", "evd").strip() + f""",
occ AS (SELECT doc_id, chunk_id, unnest({_lwords('text')}) AS token FROM ev),
lo AS (SELECT doc_id, chunk_id, count(*) AS n_tokens,
              avg(-ln((coalesce(c, 0) + 1.0) / (st.nn + st.vv + 1))) AS loss
       FROM occ LEFT JOIN cnt USING (token) CROSS JOIN st GROUP BY doc_id, chunk_id)
"""

_WINDOW_BATCHES = "WITH " + _WINDOWS_CTES.strip() + """,
o AS (SELECT doc_id, chunk_id, input_ids, row_number() OVER (ORDER BY doc_id, chunk_id) - 1 AS i,
             count(*) OVER () AS n FROM tw),
bt AS (SELECT doc_id, chunk_id, input_ids, i // 8 AS batch_id, CAST(i % 8 AS INTEGER) AS slot
       FROM o WHERE i // 8 < n // 8)
"""

ORACLE_SQL.update({
    "answers": _ANSWERS + f"""
SELECT q_id, question, answer, CAST(len({_words('answer')}) AS INTEGER) AS n_words FROM rans""",
    "benchmark_grid": _GRID + f"""
SELECT q_id, k, rerank, answer, CAST(len({_words('answer')}) AS INTEGER) AS n_words FROM ans""",
    "compare_models": _ANSWERS + f""",
ev AS (SELECT event_id, value FROM events),
fa AS (SELECT item_id AS q_id, text AS question,
              {_stub_answer(_plain_prompt('text'))} AS answer FROM benchmark),
j AS (SELECT r.question, r.answer AS rag_answer, f.answer AS ft_answer,
             coalesce(e1.value, 0) AS rag_time, coalesce(e2.value, 0) AS ft_time
      FROM rans r LEFT JOIN ev e1 ON e1.event_id = 2 * r.q_id
      JOIN fa f ON f.q_id = r.q_id
      LEFT JOIN ev e2 ON e2.event_id = 2 * f.q_id + 1)
SELECT question, rag_answer, ft_answer, round(rag_time, 6) AS rag_time, round(ft_time, 6) AS ft_time,
       round(rag_time - ft_time, 6) AS time_difference,
       round(CASE WHEN len({_words('rag_answer')}) > 0 THEN rag_time / len({_words('rag_answer')})
                  ELSE 0 END, 6) AS rag_time_per_token,
       round(CASE WHEN len({_words('ft_answer')}) > 0 THEN ft_time / len({_words('ft_answer')})
                  ELSE 0 END, 6) AS ft_time_per_token
FROM j""",
    "perplexity_unigram": _PPL + """
SELECT count(*) AS n_chunks, round(coalesce(avg(exp(loss)), 'inf'::DOUBLE), 4) AS perplexity FROM lo""",
    "chunk_perplexity": _PPL + """
SELECT doc_id, chunk_id, n_tokens, round(loss, 9) AS loss, round(exp(loss), 4) AS perplexity FROM lo""",
    "batch_assign": _WINDOW_BATCHES + "SELECT doc_id, chunk_id, batch_id, slot FROM bt",
    "collate_batches": _WINDOW_BATCHES + """,
c AS (SELECT batch_id, slot, input_ids, max(len(input_ids)) OVER (PARTITION BY batch_id) - len(input_ids)
             AS short FROM bt)
SELECT batch_id, slot,
       (input_ids || list_transform(range(short), lambda x: 0))::INTEGER[] AS input_ids,
       (input_ids || list_transform(range(short), lambda x: -100))::INTEGER[] AS labels,
       (list_transform(input_ids, lambda x: 1) || list_transform(range(short), lambda x: 0))::INTEGER[]
         AS attention_mask
FROM c""",
    "shard_assign": """
WITH o AS (SELECT doc_id, row_number() OVER (ORDER BY md5('0:0:' || doc_id), doc_id) - 1 AS i,
                  count(*) OVER () AS n FROM documents),
w AS (SELECT doc_id, i FROM o UNION ALL SELECT doc_id, i + n FROM o WHERE i < (3 - n % 3) % 3)
SELECT doc_id, CAST(i % 3 AS INTEGER) AS shard, i // 3 AS position FROM w""",
    "step_plan": _WINDOW_BATCHES + """
SELECT batch_id, count(*) AS n_rows, batch_id % 8 = 0 AS update_after, (batch_id + 7) // 8 AS step
FROM bt GROUP BY batch_id""",
})


ORACLE_SQL.update({
    "knn_cells": f"""
WITH t AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS d
           FROM embeddings),
cen AS (SELECT CAST(label AS INTEGER) AS cell_id, list(v ORDER BY d) AS c
        FROM (SELECT label, d, sum(x) / greatest(count(*)::DOUBLE, 1e-9) AS v FROM t GROUP BY label, d)
        GROUP BY label),
vc AS (SELECT e.vec_id, c.cell_id, {_D2.format(a='e.embedding', b='c.c')} AS dc
       FROM embeddings e, cen c),
vr AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY round(dc, 9), cell_id) AS r FROM vc),
asg AS (SELECT vec_id, cell_id FROM vr WHERE r = 1),
qp AS (SELECT vec_id AS q_id, cell_id FROM vr WHERE r <= 2),
d AS (SELECT qp.q_id, a.vec_id, {_D2.format(a='q.embedding', b='v.embedding')} AS d2
      FROM qp JOIN asg a USING (cell_id)
      JOIN embeddings q ON q.vec_id = qp.q_id JOIN embeddings v ON v.vec_id = a.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY round(d2, 9), vec_id) AS rk FROM d)
SELECT q_id, vec_id, CAST(rk AS INTEGER) AS rank, round(d2, 6) AS d2 FROM r WHERE rk <= 5""",
    "store_build": "WITH " + _chunks_cte("ch", 64).strip() + """
SELECT (SELECT count(*) FROM documents) AS n_documents, count(*) AS n_chunks, 64 AS dim,
       'Flat' AS index_type FROM ch""",
    "store_roundtrip": ORACLE_SQL["search_text"],
    "samples_roundtrip": ORACLE_SQL["token_windows_padded"],
})


ORACLE_SQL.update({
    "extract_answers": f"""
WITH p AS (SELECT doc_id, ({_EXTRACT} || {_NL2} || 'Text: ' || text) AS prompt FROM documents),
t AS (SELECT doc_id, CASE WHEN strpos(prompt, 'Text: ') > 0
                          THEN substr(prompt, strpos(prompt, 'Text: ') + 6) ELSE prompt END AS tail
      FROM p)
SELECT doc_id, answer, CAST(len({_words('answer')}) AS INTEGER) AS n_words
FROM (SELECT doc_id, {_digest_answer('tail')} AS answer FROM t)""",
})


def _split_exact_of(source: str) -> str:
    return f"""
SELECT stem, text_md5, CASE WHEN i < floor(n * 0.9) THEN 'train' ELSE 'eval' END AS split
FROM (SELECT stem, text_md5, row_number() OVER (ORDER BY md5('42:' || stem), stem) - 1 AS i,
             count(*) OVER () AS n FROM {source})"""


ORACLE_SQL.update({
    "knn_near_ties": "WITH " + _hash_embed_cte(
        "qe", "(SELECT item_id AS q_id, text AS question FROM benchmark)", "q_id", "question").strip() + f""",
v AS (SELECT q_id * 100 + r AS row_id, e FROM qe, (SELECT unnest(range(1, 25)) AS r)),
d AS (SELECT q.q_id, v.row_id, {_D2.format(a='q.e', b='v.e')} AS d2 FROM qe q, v),
r AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY round(d2, 9), row_id) AS rk FROM d)
SELECT q_id, row_id, CAST(rk AS INTEGER) AS rank, round(d2, 6) AS d2 FROM r WHERE rk <= 5""",
    "corpus_incremental": f"""
WITH d AS (SELECT 'doc' || doc_id AS stem, md5(text) AS text_md5,
                  doc_id IN (SELECT doc_id FROM labels) AS l FROM documents),
a AS (SELECT * FROM d WHERE l), b AS (SELECT * FROM d WHERE NOT l)
SELECT *, (SELECT count(*) FROM a) AS first_processed, (SELECT count(*) FROM b) AS second_processed,
       (SELECT count(*) FROM a) AS second_skipped
FROM ({_split_exact_of('a')} UNION ALL {_split_exact_of('b')})""",
    "store_append": ORACLE_SQL["search_text"],
    "collate_given_mask": _WINDOW_BATCHES + """,
c AS (SELECT batch_id, slot, input_ids, max(len(input_ids)) OVER (PARTITION BY batch_id) - len(input_ids)
             AS short FROM bt)
SELECT batch_id, slot,
       (list_transform(range(len(input_ids)), lambda i: CASE WHEN i % 3 = 2 THEN 0 ELSE 1 END)
        || list_transform(range(short), lambda x: 0))::INTEGER[] AS attention_mask
FROM c""",
    "shard_small": """
WITH o AS (SELECT doc_id, row_number() OVER (ORDER BY md5('0:0:' || doc_id), doc_id) - 1 AS i,
                  count(*) OVER () AS n FROM documents),
w AS (SELECT doc_id, unnest(range(i, 2 * n + 1, n)) AS p FROM o)
SELECT doc_id, CAST(p AS INTEGER) AS shard, CAST(0 AS BIGINT) AS position FROM w""",
    "compare_repeated": f"""
WITH q AS (SELECT item_id AS q_id, text AS question FROM benchmark
           UNION ALL SELECT item_id + 1000000, text FROM benchmark),
p AS (SELECT q_id, question, {_rag_prompt('question', 'question')} AS rp,
             {_plain_prompt('question')} AS pp FROM q)
SELECT question, {_stub_answer('rp')} AS rag_answer, {_stub_answer('pp')} AS ft_answer,
       round(q_id * 0.5::DOUBLE - q_id * 0.25::DOUBLE, 6) AS time_difference FROM p""",
    "mean_pool_masked": """
WITH t AS (SELECT label, CAST(vec_id % 3 <> 0 AS INTEGER) AS m, unnest(embedding)::DOUBLE AS x,
                  generate_subscripts(embedding, 1) AS d FROM embeddings),
s AS (SELECT label, d, sum(x * m) / greatest(sum(m)::DOUBLE, 1e-9) AS v FROM t GROUP BY label, d)
SELECT label, list(round(v, 6) ORDER BY d) AS pooled FROM s GROUP BY label""",
    "split_written": f"SELECT doc_id, n_chars, split FROM ({_SPLIT_HASH}) JOIN documents USING (doc_id)",
    "report_csv": f"""
SELECT lang, count(*) AS n_docs, CAST(sum(len({_words('text')})) AS BIGINT) AS n_words
FROM documents GROUP BY lang""",
    "documents_scan": "SELECT doc_id, md5(text) AS text_md5 FROM documents",
    "chunk_metadata_scan": "WITH " + _chunks_cte("mc", 1500, ", source, lang").strip() + """
SELECT md5(text) AS text_md5, coalesce(source, 'unknown') AS source, chunk_id FROM mc""",
    "recursive_chunk_rules": f"""
SELECT doc_id, true AS all_short, true AS all_contained, true AS in_order, true AS words_kept
FROM documents WHERE len({_words('text')}) > 0""",
})


ORACLE_SQL.update({
    "loader_text": """
SELECT doc_id, CAST(0 AS INTEGER) AS page_no, CAST(length(text) AS INTEGER) AS n_chars,
       md5(text) AS text_md5 FROM documents WHERE text IS NOT NULL""",
    "loader_paged": """
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, text) - 1 AS INTEGER) AS page_no,
       CAST(length(text) AS INTEGER) AS n_chars, md5(text) AS text_md5
FROM conversations WHERE text IS NOT NULL""",
    "loader_jsonl": """
SELECT doc_id, lang, n_chars, md5(text) AS text_md5 FROM documents WHERE text IS NOT NULL""",
    "knn_ivf_exact": ORACLE_SQL["knn_flat"],
    "batch_null_repeated": f"""
WITH d AS (SELECT *, row_number() OVER (ORDER BY given_id NULLS FIRST, orig) - 1 AS doc_row FROM (
  SELECT CASE WHEN doc_id % 5 <> 0 THEN doc_id // 2 END AS given_id, doc_id AS orig, text FROM documents)),
w AS (SELECT given_id, doc_row, {_words('text')} AS ws FROM d),
c AS (SELECT given_id, doc_row, chunk_id, array_to_string(ws[chunk_id * 64 + 1:chunk_id * 64 + 64], ' ') AS text
      FROM (SELECT *, unnest(range(0, (len(ws) + 63) // 64)) AS chunk_id FROM w)),
o AS (SELECT *, row_number() OVER (ORDER BY doc_row, chunk_id) - 1 AS i, count(*) OVER () AS n FROM c)
SELECT given_id AS doc_id, doc_row, CAST(chunk_id AS INTEGER) AS chunk_id, i // 8 AS batch_id,
       CAST(i % 8 AS INTEGER) AS slot, md5(text) AS text_md5 FROM o WHERE i // 8 < n // 8""",
})


def _pairs_of(source: str, keys: str) -> str:
    """Words of ``ws`` with the word before (null before the first)."""
    return f"""SELECT {keys}CASE WHEN i > 1 THEN ws[i - 1] END AS v, ws[i] AS w
      FROM (SELECT {keys}ws, unnest(range(1, len(ws) + 1)) AS i FROM {source})"""


# back-off bigrams, discount 0.75
ORACLE_SQL["perplexity_bigram"] = "WITH " + f"""
sp AS ({_SPLIT_HASH}),
dsp AS (SELECT d.*, sp.split FROM documents d JOIN sp USING (doc_id)),
evd AS (SELECT * FROM dsp WHERE split = 'eval'),""" + _chunks_cte("ev", 1500, "", "evd").strip() + f""",
tw AS (SELECT {_lwords('text')} AS ws FROM dsp WHERE split = 'train'),
ew AS (SELECT doc_id, chunk_id, {_lwords('text')} AS ws FROM ev),
tp AS ({_pairs_of('tw', '')}),
ep AS ({_pairs_of('ew', 'doc_id, chunk_id, ')}),
seen AS (SELECT v, w, count(*) AS c FROM tp WHERE v IS NOT NULL GROUP BY v, w),
bef AS (SELECT v, sum(c) AS cv, count(*) AS tv FROM seen GROUP BY v),
fol AS (SELECT w, count(*) AS f FROM seen GROUP BY w),
tot AS (SELECT sum(f)::DOUBLE AS b, count(*)::DOUBLE AS t FROM fol),
lw AS (SELECT doc_id, chunk_id, c, cv, tv,
              (greatest(coalesce(f, 0) - 0.75::DOUBLE, 0) + 0.75::DOUBLE * t / (t + 1)) / b AS low
       FROM ep LEFT JOIN seen ON ep.v = seen.v AND ep.w = seen.w
       LEFT JOIN bef ON ep.v = bef.v LEFT JOIN fol ON ep.w = fol.w CROSS JOIN tot),
lo AS (SELECT doc_id, chunk_id, count(*) AS n_tokens,
              avg(-ln(CASE WHEN cv IS NULL THEN low ELSE
                (greatest(coalesce(c, 0) - 0.75::DOUBLE, 0) + 0.75::DOUBLE * tv * low) / cv END)) AS loss
       FROM lw GROUP BY doc_id, chunk_id)
SELECT doc_id, chunk_id, n_tokens, round(loss, 7) AS loss, round(exp(loss), 3) AS perplexity FROM lo"""


ORACLE_SQL.update({
    "job_windows": ORACLE_SQL["token_windows_padded"],
    "job_search": ORACLE_SQL["search_rerank"],
    "job_answer": _ANSWERS + """
SELECT q_id, question, answer, CAST(5 AS INTEGER) AS n_chunks, true AS timed FROM rans""",
    "job_benchmark": _GRID + """
SELECT b.text AS question, k, rerank, answer FROM ans JOIN benchmark b ON b.item_id = q_id""",
    "job_compare": _ANSWERS + f"""
SELECT question, answer AS rag_answer, ft_answer FROM rans JOIN (
  SELECT item_id, {_stub_answer(_plain_prompt('text'))} AS ft_answer FROM benchmark) ON item_id = q_id""",
    "job_perplexity": ORACLE_SQL["perplexity_unigram"],
    "job_extract": f"""
WITH p AS (SELECT doc_id, ({_EXTRACT} || {_NL2} || 'Text: ' || text) AS prompt FROM documents)
SELECT doc_id, md5(prompt) AS prompt_md5, {_digest_answer("substr(prompt, strpos(prompt, 'Text: ') + 6)")} AS answer
FROM p""",
    "prompt_files": f"""
SELECT prompt, {_stub_answer('prompt')} AS answer
FROM (SELECT {_plain_prompt('text')} AS prompt FROM benchmark)""",
    "knn_few_rows": f"""
WITH x AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
m AS (SELECT label, list(a ORDER BY i) AS e FROM (SELECT label, i, avg(x) AS a FROM x GROUP BY label, i)
      GROUP BY label),
d AS (SELECT vec_id AS q_id, m.label, {_D2.format(a='q.embedding', b='m.e')} AS d2 FROM embeddings q, m)
SELECT q_id, CAST(label AS BIGINT) AS label,
       CAST(row_number() OVER (PARTITION BY q_id ORDER BY round(d2, 9), label) AS INTEGER) AS rank,
       round(d2, 6) AS d2 FROM d""",
    "store_append_named": ORACLE_SQL["search_text"],
    "vocab_encode_cold": ORACLE_SQL["vocab_encode"],
})
