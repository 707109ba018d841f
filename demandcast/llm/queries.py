"""Registered queries of the subpackage, (spark, sf_dir) -> DataFrame, and
their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandcast.llm import chat, collision_ann, mixing, prefix_trie, quality_classifier, quality_rules, sentencepiece_bpe, simhash, structure_repair, substring_dedup, topk, toxicity, warc
from demandcast.llm.common import Scratch, table


def op1_simhash(spark, d):
    found = simhash.groups(table(spark, d, "documents"), Scratch(spark, "simhash"))
    return found.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op2_sentencepiece(spark, d):
    return sentencepiece_bpe.encode_digests(table(spark, d, "documents"))


def op3_quality_rules(spark, d):
    book = quality_rules.ledger(quality_rules.measure(table(spark, d, "documents")))
    return quality_rules.apply_policy(book).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.passes(quality_rules.BASE)).alias("base_failed"), "kept",
        "n_lines", "n_upper", "failures",
    )


def op4_quality_classifier(spark, d):
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    found = quality_classifier.posterior(docs, labels, Scratch(spark, "quality"))
    return found.select(
        F.col("_id").alias("doc_id"), "text_probability", "site_share", "path_share", "probability",
        (F.col("probability") >= quality_classifier.THRESHOLD).alias("kept"))


def op5_topk(spark, d):
    vectors = table(spark, d, "embeddings")
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0), Scratch(spark, "topk"), k=5)


def op6_toxicity(spark, d):
    return toxicity.classify(table(spark, d, "documents"), table(spark, d, "labels"))


def op7_substring_dedup(spark, d):
    return substring_dedup.removed(table(spark, d, "documents"), Scratch(spark, "substring"))


def op8_mixing(spark, d):
    return mixing.mix(table(spark, d, "documents"), Scratch(spark, "mix"))


#: Conversation -1 of the contract: both texts imitate a template's controls.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op9_chat(spark, d):
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"))
    return chat.conversation_digests(chat.render(chat.streamed_rows(rows.unionByName(own))))


def op10_warc(spark, d):
    return warc.read(warc.build(table(spark, d, "pages"), Scratch(spark, "warc")))


def repaired_conversations(conversations, scratch):
    """Report and digests of the damaged conversations' repair."""
    damaged = structure_repair.damage(conversations)
    report, messages = structure_repair.repair(damaged, scratch)
    return structure_repair.summary(conversations, report, messages)


def op11_structure_repair(spark, d):
    return repaired_conversations(table(spark, d, "conversations"), Scratch(spark, "repair"))


def conversation_trie(conversations, scratch):
    """Trie of the conversations rebuilt to share beginnings."""
    turns, ids = prefix_trie.conversations(conversations, scratch)
    turns, ids = prefix_trie.rebuild(turns, ids)
    return prefix_trie.trie(scratch.write(turns, "rebuilt"), ids, scratch)


def op12_prefix_trie(spark, d):
    return conversation_trie(table(spark, d, "conversations"), Scratch(spark, "trie"))


def op13_nearest(spark, d):
    vectors = table(spark, d, "embeddings")
    return collision_ann.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0), Scratch(spark, "nearest"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_quality_rules": op3_quality_rules,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_topk": op5_topk,
    "op6_toxicity": op6_toxicity,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_mixing": op8_mixing,
    "op9_chat": op9_chat,
    "op10_warc": op10_warc,
    "op11_structure_repair": op11_structure_repair,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_nearest": op13_nearest,
}

# Words of a text as the contracts define them; window functions are spelled
# with correlated list functions, since rows of a text are independent.
_RULES = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), g AS (
  SELECT *, list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) AS grams FROM w
), p AS (
  SELECT row_number() OVER () AS rid, doc_id, t, words, lines, grams FROM g
), x AS (
  SELECT rid, unnest(grams) AS gram, unnest(range(1, len(grams) + 1)) AS pos FROM p
), r AS (
  SELECT rid, pos FROM (SELECT rid, pos, count(*) OVER (PARTITION BY rid, gram) AS n FROM x) WHERE n > 1
), c AS (
  SELECT rid, sum(least(5, coalesce(nxt - pos, 5))) AS covered
  FROM (SELECT rid, pos, lead(pos) OVER (PARTITION BY rid ORDER BY pos) AS nxt FROM r) GROUP BY rid
), m AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(covered, 0)::BIGINT AS n_repeat_words,
         len(lines)::BIGINT AS n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g'))::BIGINT AS n_upper
  FROM p LEFT JOIN c USING (rid)
), f AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END
    | CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    | CASE WHEN 3 * n_symbols > n_words THEN 4 ELSE 0 END
    | CASE WHEN n_lines > 3 AND 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
    | CASE WHEN word_chars < 2 * n_words OR word_chars > 25 * n_words THEN 16 ELSE 0 END
    | CASE WHEN 2 * n_upper > word_chars THEN 32 ELSE 0 END)::BIGINT AS failures FROM m
)
SELECT *, (failures & 3) <> 0 AS base_failed, failures = 0 AS kept FROM f
"""

_TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.e::DOUBLE[], v.e::DOUBLE[])::BIGINT AS score
  FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

_MIXING = """
WITH n AS (
  SELECT source, count(*) AS n FROM documents GROUP BY source
), r AS (
  SELECT source, sqrt(n) / (SELECT sum(sqrt(n)) FROM n) * (SELECT sum(n) FROM n)::DOUBLE / n AS rate FROM n
), p AS (
  SELECT source, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS cdf
  FROM r, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 20)::INTEGER + 1)) AS u(k)
), t AS (
  SELECT source, list(cdf ORDER BY k) AS cdf FROM p GROUP BY source
), c AS (
  SELECT d.*, len(list_filter(cdf, lambda x: x <= ('0x' || substr(md5('mix-1:' || doc_id), 1, 13))::BIGINT / 4503599627370496.0)) AS copies
  FROM documents AS d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT c.* EXCLUDE (copies), u.k::INTEGER AS copy, md5('mix-1:' || doc_id || ':' || u.k) AS shuffle_key
FROM c, unnest(range(1, copies + 1)) AS u(k)
"""

_CHAT = r"""
WITH e AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), x AS (
  SELECT *, '<|im_start|>' || role || chr(10) || regexp_replace(replace(text, '\', '\\'),
    '(<)(\|im_(?:start|end)\|>|/?s>|</?SYS>>)|(\[)(/?INST\])', '\1\3\\\2\4', 'g') || '<|im_end|>' || chr(10) AS segment FROM e
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(segment))::BIGINT AS formatted_chars
FROM x GROUP BY conv_id
"""

_WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), k AS (
  SELECT html, max(page_id) AS keeper FROM p WHERE strlen(html) >= 1000 GROUP BY html
)
SELECT page_id, strlen(p.html)::BIGINT AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN keeper IS NOT NULL AND page_id IS DISTINCT FROM keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keeper IS NOT NULL AND page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to
FROM p LEFT JOIN k USING (html)
"""

# crc32 of decimal text: a byte at a time, a bit at a time
_CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({}, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda k, z: xor(k >> 1, (k & 1) * 3988292384))), 4294967295)"""

_TRIE = f"""
WITH t AS (
  SELECT conv_id, turn, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS m,
         sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list(m ORDER BY turn NULLS FIRST, k) AS turns FROM t GROUP BY conv_id
), s AS (
  SELECT o.conv_id, list_concat(coalesce(b.turns, [])[1:o.h], o.turns[o.h + 1:]) AS turns
  FROM (SELECT *, {_CRC.format("conv_id::VARCHAR")} % 9 AS h FROM own) AS o LEFT JOIN own AS b ON b.conv_id = o.conv_id - o.conv_id % 5
), p AS (
  SELECT conv_id, len(turns) AS n, d, turns[1:d] AS node FROM s, unnest(range(0, len(turns) + 1)) AS u(d)
), n AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256,
         CASE WHEN d > 0 THEN (count(*) - 1) * strlen(node[d].text) ELSE 0 END AS saves, max(n) = d AS leaf
  FROM p GROUP BY node, d
), a AS (
  SELECT node[1:e] AS node, e AS d, sum(saves) AS saved, count(*) FILTER (leaf) AS leaves, count(*) FILTER (d = e + 1) AS children
  FROM n, unnest(range(0, d + 1)) AS u(e) GROUP BY ALL
)
SELECT n.conv_id, n.d AS depth, b.conv_id AS parent_conv_id, n.n_convs, a.children AS n_children, a.leaves AS n_leaves,
       a.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN a ON a.node = n.node AND a.d = n.d LEFT JOIN n AS b ON n.d > 0 AND b.d = n.d - 1 AND b.node = n.node[1:n.d - 1]
"""

# Least (cost, audit) per grammar state, a row at a time; up to two messages
# are inserted after each row.
_REPAIR = rf"""
WITH RECURSIVE d AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_CRC.format("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
  FROM conversations
), e AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM d, unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS u(copy)
), p AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS pos FROM e
), f AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'b'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'd'
                 WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 't' ELSE 'f' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS pair
  FROM p
), keeps(st, init, nxt) AS (
  VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)
), inserts(st, nxt, letters, lines) AS (
  VALUES (0, 0, '', []::VARCHAR[]), (1, 1, '', []), (2, 2, '', []), (3, 3, '', []),
         (0, 2, 'I', ['user:']), (1, 2, 'I', ['user:']), (2, 3, 'I', ['assistant:']), (3, 2, 'I', ['user:']),
         (0, 3, 'II', ['user:', 'assistant:']), (1, 3, 'II', ['user:', 'assistant:'])
), r AS (
  SELECT c.conv_id, 0::BIGINT AS i, nxt AS st, (2 * length(letters))::BIGINT AS cost, letters AS audit, lines
  FROM (SELECT DISTINCT conv_id FROM e) AS c, inserts WHERE inserts.st = 0
  UNION ALL
  SELECT conv_id, i, st, x.cost, x.audit, x.lines FROM (
    SELECT g.conv_id, g.i, n.nxt AS st, min({{'cost': g.cost + 2 * length(n.letters), 'audit': g.audit || n.letters, 'lines': list_concat(g.lines, n.lines)}}) AS x
    FROM (
      SELECT r.conv_id, r.i + 1 AS i, r.st, r.cost + 3 AS cost, r.audit || 'D' AS audit, r.lines
      FROM r JOIN f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.pos = r.i + 1
      UNION ALL
      SELECT r.conv_id, r.i + 1, keeps.nxt, r.cost + (f.fault = 't')::INT, r.audit || 'K', list_append(r.lines, f.role || ':' || f.text)
      FROM r JOIN f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.pos = r.i + 1 AND f.fault IN ('t', 'f')
      JOIN keeps ON keeps.st = r.st AND keeps.init = left(f.role, 1)
      UNION ALL
      SELECT r.conv_id, r.i + 1, CASE r.st WHEN 2 THEN 3 ELSE 2 END, r.cost + 2 + (f.fault = 't')::INT, r.audit || 'R',
             list_append(r.lines, CASE r.st WHEN 2 THEN 'assistant' ELSE 'user' END || ':' || f.text)
      FROM r JOIN f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.pos = r.i + 1 AND f.fault IN ('t', 'f')
    ) AS g JOIN inserts AS n ON n.st = g.st GROUP BY ALL
  )
), n AS (
  SELECT conv_id, count(*) AS n, (max(turn) - min(turn) + 1 - count(DISTINCT turn))::BIGINT AS gaps, count(*) FILTER (fault = 'b') AS blank,
         count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id
), best AS (
  SELECT n.conv_id, min({{'cost': r.cost, 'audit': r.audit, 'lines': r.lines}}) AS x
  FROM n JOIN r ON r.conv_id IS NOT DISTINCT FROM n.conv_id AND r.i = n.n WHERE r.st IN (0, 3) GROUP BY n.conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(x.cost, 0)::BIGINT AS cost, coalesce(x.audit, '') AS audit,
       sha256(coalesce(array_to_string(x.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS c LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id
"""

SQL = {
    "op11_structure_repair": _REPAIR,
    "op12_prefix_trie": _TRIE,
    "op5_topk": _TOPK,
    "op8_mixing": _MIXING,
    "op9_chat": _CHAT,
    "op10_warc": _WARC,
    "op3_quality_rules": _RULES,
}
