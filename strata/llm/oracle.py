"""DuckDB SQL of the registered text queries, where SQL can express them.

Each is a plain restatement over the raw tables: no hashes, shards, tries or
bounds.  Without SQL: token ids (op2, op4), the mix's draws (op9), the
classifier (op10), XXH64 (op13) and the pipeline, which the tests hold against
plain Python or the tokenizers library.
"""

#: One row for each word: document, place from 1, word.
WORDS = r"""
split_ AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words_ AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM split_)
"""

SUBSTRING = f"""
WITH {WORDS},
windows_ AS (
  SELECT doc_id, unnest(range(1, len(w) - 33)) AS i, w FROM split_ WHERE len(w) >= 35
),
keyed_ AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 34), ' ') AS k FROM windows_),
again_ AS (SELECT doc_id, i, count(*) OVER (PARTITION BY k) > 1 AS twice FROM keyed_),
covered_ AS (
  SELECT words_.doc_id, words_.i, word,
         coalesce(max(CASE WHEN twice THEN 1 ELSE 0 END) OVER (
           PARTITION BY words_.doc_id ORDER BY words_.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), 0) = 1 AS gone
  FROM words_ LEFT JOIN again_ ON words_.doc_id = again_.doc_id AND words_.i = again_.i
)
SELECT d.doc_id, count(i) AS n_words, count(i) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM documents d LEFT JOIN covered_ ON d.doc_id = covered_.doc_id
GROUP BY d.doc_id
"""

RULES = rf"""
WITH {WORDS},
triples_ AS (
  SELECT doc_id, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o AS k
  FROM words_ WINDOW o AS (PARTITION BY doc_id ORDER BY i)
),
often_ AS (
  SELECT doc_id, i, CASE WHEN k IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, k) > 1 THEN 1 ELSE 0 END AS again
  FROM triples_
),
repeats_ AS (
  SELECT doc_id, sum(hit) AS n FROM (
    SELECT doc_id, max(again) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS hit FROM often_)
  GROUP BY doc_id
),
lines_ AS (
  SELECT doc_id, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents
),
counts_ AS (
  SELECT d.doc_id, d.source, len(w) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, len(l) AS n_lines,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM documents d JOIN split_ USING (doc_id) JOIN lines_ USING (doc_id) LEFT JOIN repeats_ r USING (doc_id)
),
failed_ AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         n_symbols > 0.1 * greatest(n_words, 1) OR (n_dup_lines >= 3 AND n_dup_lines > 0.3 * greatest(n_lines, 1))
           OR word_chars > 40 * greatest(n_words, 1) AS own,
         n_symbols > 0.05 * greatest(n_words, 1) OR (n_dup_lines >= 3 AND n_dup_lines > 0.15 * greatest(n_lines, 1))
           OR word_chars > 20 * greatest(n_words, 1) AS tight
  FROM counts_
),
hosts_ AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed OR own) AS f FROM failed_ GROUP BY source),
spread_ AS (SELECT greatest(least(avg(f / n), 0.999999), 0.000001) AS m, var_samp(f / n) AS v FROM hosts_),
prior_ AS (SELECT m, CASE WHEN v > 0 THEN greatest(m * (1 - m) / v - 1, 0.001) ELSE 1.0 END AS weight FROM spread_),
suspect_ AS (SELECT source, (f + m * weight) / (n + weight) > 0.5 AS suspect FROM hosts_, prior_)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT own AND NOT (suspect AND tight) AS kept
FROM failed_ JOIN suspect_ ON failed_.source IS NOT DISTINCT FROM suspect_.source
"""

TOPK = """
WITH vectors_ AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
parts_ AS (SELECT vec_id, unnest(v) AS x, unnest(range(len(v))) AS d FROM vectors_),
scores_ AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM parts_ q JOIN parts_ c ON q.d = c.d AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0 GROUP BY 1, 2
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scores_ QUALIFY rank <= 20
"""

CHAT = r"""
WITH turns_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
placed_ AS (
  SELECT *, row_number() OVER o - 1 AS place, coalesce(lag(role) OVER o, 'start') AS before,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC NULLS LAST, role DESC, text DESC) = 1 AS last,
         length(regexp_replace(replace(text, '\', '\\'),
           '([\[<])(SYS\]|/SYS\]|INST\]|/INST\]|OUT\]|TURN |/TURN\]|s>|/s>)', '\1\\\2', 'g'))
         + CASE role WHEN 'system' THEN length('[SYS]  [/SYS]') WHEN 'user' THEN length('[INST]  [/INST]')
                     WHEN 'assistant' THEN length('[OUT] </s>')
                     ELSE length('[TURN ]  [/TURN]') + length(replace(regexp_replace(replace(role, '\', '\\'),
                       '([\[<])(SYS\]|/SYS\]|INST\]|/INST\]|OUT\]|TURN |/TURN\]|s>|/s>)', '\1\\\2', 'g'), ']', '\]')) END AS written
  FROM turns_ WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
),
judged_ AS (
  SELECT *, before || ' ' || role NOT IN ('start system', 'start user', 'system user', 'user assistant', 'assistant user') AS bad
  FROM placed_
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(written) AS BIGINT) AS formatted_chars,
       count(*) FILTER (bad) = 0 AND max(CASE WHEN last THEN role END) = 'assistant' AS valid,
       CAST(min(place) FILTER (bad) AS INTEGER) AS first_bad_turn
FROM judged_ GROUP BY conv_id
"""

JACCARD = r"""
WITH RECURSIVE
split_ AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
),
shingles_ AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM split_ WHERE len(w) > 0)
),
sizes_ AS (SELECT doc_id, count(*) AS n FROM shingles_ GROUP BY doc_id),
shared_ AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM shingles_ a JOIN shingles_ b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
links_ AS (
  SELECT a, b FROM shared_ JOIN sizes_ x ON a = x.doc_id JOIN sizes_ y ON b = y.doc_id WHERE 100 * o >= 75 * (x.n + y.n - o)
),
reach_ AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach_.a, links_.b FROM reach_ JOIN links_ ON reach_.b = links_.a
)
SELECT d.doc_id, coalesce(max(n), 0) AS n_shingles, min(b) AS component_id
FROM documents d LEFT JOIN sizes_ USING (doc_id) JOIN reach_ ON d.doc_id = reach_.a GROUP BY d.doc_id
"""

def _vector_codes(rounds: int = 6) -> str:
    """Codebooks after each round, every part compared with every entry."""

    def assigned(k: int) -> str:
        return f"""
far{k}_ AS (
  SELECT r, part, entry, CAST(sum((p.x - c.x) * (p.x - c.x)) AS BIGINT) AS d
  FROM parts_ p JOIN book{k}_ c USING (part, pos) GROUP BY ALL
),
near{k}_ AS (SELECT r, part, entry, d FROM far{k}_ QUALIFY row_number() OVER (PARTITION BY r, part ORDER BY d, entry) = 1)"""

    def moved(k: int) -> str:
        return f"""
sums{k}_ AS (
  SELECT part, entry, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
  FROM near{k}_ JOIN parts_ USING (r, part) GROUP BY ALL
),
book{k + 1}_ AS (
  SELECT part, entry, pos, CASE WHEN n IS NULL THEN x ELSE CAST((s - ((s % n) + n) % n) / n AS BIGINT) END AS x
  FROM book{k}_ LEFT JOIN sums{k}_ USING (part, entry, pos)
)"""

    steps = ",".join(f"{assigned(k)},{moved(k)}" for k in range(rounds)) + "," + assigned(rounds)
    return f"""
WITH whole_ AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
vectors_ AS (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS r FROM whole_),
flat_ AS (SELECT r, unnest(v) AS x, unnest(range(len(v))) AS i, len(v) // 8 AS d FROM vectors_),
parts_ AS (SELECT r, i // d AS part, i % d AS pos, x FROM flat_),
book0_ AS (SELECT part, r AS entry, pos, x FROM parts_ WHERE r < 16),{steps},
whole_book_ AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) AS h FROM book{rounds}_),
coded_ AS (
  SELECT r, string_agg(format('{{:02x}}', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near{rounds}_ GROUP BY r
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM vectors_ JOIN coded_ USING (r), whole_book_
"""


SKETCHES = r"""
WITH split_ AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents
),
all_ AS (SELECT count(*) AS n, CAST(sum(len(t)) AS BIGINT) AS l FROM split_ WHERE len(t) > 0),
items_ AS (
  SELECT DISTINCT item_id, text, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
),
terms_ AS (SELECT doc_id, r, len(t) AS n, unnest(t) AS term FROM split_),
tf_ AS (SELECT doc_id, r, n, term, count(*) AS tf FROM terms_ WHERE term IN (SELECT term FROM items_) GROUP BY ALL),
weights_ AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(all_.n) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf_, all_ GROUP BY term
),
scores_ AS (
  SELECT item_id, text, doc_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * tf_.n * all_.n) // all_.l)))) AS BIGINT) AS score
  FROM items_ JOIN tf_ USING (term) JOIN weights_ USING (term), all_ GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scores_ WHERE score > 0 QUALIFY rank <= 50
"""

ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": SUBSTRING,
    "op3_quality_rules": RULES,
    "op5_maxscore_topk": TOPK,
    "op7_chat_formatting": CHAT,
    "op8_ngram_join": JACCARD,
    "op11_vector_codes": _vector_codes(),
    "op12_sketch_search": SKETCHES,
}
