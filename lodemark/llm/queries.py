"""Registered queries of the corpus operators: whole tables, production parameters, and SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodemark.llm import collocations, jaccard, langid, neighbours, notices, packing, pieces, preference, quality, sharding, spans, trie, warc
from lodemark.llm.common import WORD, table
from lodemark.sources.scans import Scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn
    return register


CRC_SQL = """
crc_table AS (
  SELECT list(v ORDER BY i) AS crcs FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, s: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256))::BIGINT AS i))),"""


@query(f"""
WITH {CRC_SQL}
docs AS (
  SELECT doc_id, text, coalesce('s' || source, '') AS source, md5('0|' || doc_id) AS digest,
         coalesce(octet_length(encode(text)), 0) + 1 AS size,
         list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::BIGINT) AS bytes
  FROM documents),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY source ORDER BY digest, doc_id)
             - (1.0::DOUBLE - ('0x' || substr(md5('0|' || source), 1, 8))::BIGINT / 4294967296.0::DOUBLE))
            / count(*) OVER (PARTITION BY source)::DOUBLE AS fraction
  FROM docs),
placed AS (SELECT *, row_number() OVER (ORDER BY fraction, digest, doc_id, source) - 1 AS pos, count(*) OVER () AS n FROM ranked),
cut AS (SELECT *, (pos * 16) // n AS shard FROM placed)
SELECT doc_id, size,
       xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295)::BIGINT AS text_crc32,
       'rows' AS law, shard::INTEGER AS shard, pos - (shard * n + 15) // 16 AS slot, NULL::INTEGER AS grown_shard
FROM cut, crc_table""")
def op1_interleaved_shards(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32("text").alias("text_crc32"))
    return sharding.interleave(docs, "doc_id", "source", n_shards=16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query()
def op2_language_mixture(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    languages = langid.learn(docs.where(langid.fold("doc_id") != 1), "text", "lang")
    judged = langid.infer(docs, "text", languages, carry=["doc_id"])
    return judged.select("doc_id", (langid.fold("doc_id") == 1).alias("held_out"), "lang_pred", "score", F.to_json("lang_shares").alias("lang_shares"))


@query("""
WITH pieces AS (
  SELECT doc_id, text, unnest(p) AS piece, unnest(range(1, len(p) + 1)) AS i
  FROM (SELECT doc_id, text, regexp_extract_all(text, '[^.!?\\n]+[.!?\\n]*[\\x09-\\x0D\\x20]*|[.!?\\n]+[\\x09-\\x0D\\x20]*') AS p FROM documents)),
worded AS (SELECT *, regexp_extract_all(piece, '[^\\x20\\x09-\\x0D]+') AS w FROM pieces),
numbered AS (SELECT *, sum(CASE WHEN len(w) > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS number FROM worded),
sents AS (
  SELECT doc_id, number AS k, array_to_string(w, ' ') AS s, len(w) AS n,
         sum(len(w)) OVER (PARTITION BY doc_id ORDER BY number) AS upto FROM numbered WHERE len(w) > 0),
ends AS (
  SELECT a.doc_id, a.k, min(b.k) AS j
  FROM sents a JOIN sents b ON a.doc_id = b.doc_id AND b.k >= a.k
   AND ((b.k > a.k AND b.upto - a.upto + a.n >= 20) OR b.upto - a.upto + a.n >= 40)
  GROUP BY ALL),
runs AS (
  SELECT e.doc_id, e.k, e.j, string_agg(s.s, ' ' ORDER BY s.k) AS run
  FROM ends e JOIN sents s ON e.doc_id = s.doc_id AND s.k BETWEEN e.k AND e.j GROUP BY ALL),
later AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, k) AS nth FROM runs),
gone AS (SELECT DISTINCT s.doc_id, s.k FROM later l JOIN sents s ON l.nth > 1 AND l.doc_id = s.doc_id AND s.k BETWEEN l.k AND l.j),
cleaned AS (
  SELECT n.doc_id, coalesce(string_agg(CASE WHEN g.k IS NULL THEN piece END, '' ORDER BY i), '') AS text
  FROM numbered n LEFT JOIN gone g ON n.doc_id = g.doc_id AND greatest(n.number, 1) = g.k GROUP BY ALL)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(c.text, '') END AS text,
       coalesce(x.n, 0)::INTEGER AS n_sentences, coalesce(y.n, 0)::INTEGER AS n_removed
FROM documents d LEFT JOIN cleaned c USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM sents GROUP BY ALL) x USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY ALL) y USING (doc_id)""")
def op3_sentence_spans(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spans.drop_repeated_spans(docs, "doc_id", "text").select("doc_id", "text", "n_sentences", "n_removed")


TURNS_SQL = """
turns AS (
  SELECT conv_id, list({'role': coalesce(role, 'user'), 'text': coalesce(text, '')}
                       ORDER BY turn NULLS FIRST, coalesce(role, 'user'), coalesce(text, '')) AS turns
  FROM conversations GROUP BY conv_id),
marked AS (
  SELECT *, CASE WHEN list_contains(list_transform(turns, lambda x: x.role), 'assistant')
                 THEN len(turns) - list_position(list_reverse(list_transform(turns, lambda x: x.role)), 'assistant') + 1 END AS last
  FROM turns),
pairs AS (
  SELECT a.conv_id, a.turns AS chosen,
         CASE WHEN a.last IS NULL THEN a.turns
              WHEN b.last IS NULL THEN a.turns[1:a.last - 1]
              ELSE list_append(a.turns[1:a.last - 1], b.turns[b.last]) END AS rejected
  FROM marked a LEFT JOIN marked b ON xor(a.conv_id, 1) = b.conv_id),
shared AS (
  SELECT *, (list_position(list_append(list_transform(range(least(len(chosen), len(rejected))),
             lambda k: chosen[k + 1] = rejected[k + 1]), false), false) - 1)::INTEGER AS n_shared
  FROM pairs),
parts AS (
  SELECT conv_id, n_shared,
         list_transform(chosen[1:n_shared], lambda x: '<|im_start|>' || replace(x.role, '<|', '< |') || chr(10) || replace(x.text, '<|', '< |') || '<|im_end|>' || chr(10)) AS p,
         list_transform(chosen[n_shared + 1:], lambda x: {'r': x.role, 's': '<|im_start|>' || replace(x.role, '<|', '< |') || chr(10), 'b': replace(x.text, '<|', '< |') || '<|im_end|>' || chr(10)}) AS c,
         list_transform(rejected[n_shared + 1:], lambda x: {'r': x.role, 's': '<|im_start|>' || replace(x.role, '<|', '< |') || chr(10), 'b': replace(x.text, '<|', '< |') || '<|im_end|>' || chr(10)}) AS j
  FROM shared),
ends AS (
  SELECT *, list_transform(range(len(c)), lambda k: list_sum(list_transform(c[1:k + 1], lambda x: length(x.s || x.b)))::BIGINT) AS ce,
            list_transform(range(len(j)), lambda k: list_sum(list_transform(j[1:k + 1], lambda x: length(x.s || x.b)))::BIGINT) AS je
  FROM parts)"""


def _spans(mask: str):
    return F.array_join(F.transform(mask, lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")


@query(f"""
WITH {TURNS_SQL}
SELECT conv_id, n_shared, array_to_string(p, '') AS prompt,
       array_to_string(list_transform(c, lambda x: x.s || x.b), '') AS chosen_completion,
       array_to_string(list_transform(list_filter(range(1, len(c) + 1), lambda k: c[k].r = 'assistant'), lambda k: (ce[k] - length(c[k].b)) || '-' || ce[k]), ',') AS chosen_mask,
       array_to_string(list_transform(j, lambda x: x.s || x.b), '') AS rejected_completion,
       array_to_string(list_transform(list_filter(range(1, len(j) + 1), lambda k: j[k].r = 'assistant'), lambda k: (je[k] - length(j[k].b)) || '-' || je[k]), ',') AS rejected_mask
FROM ends""")
def op4_preference_pairs(spark, sf_dir):
    talks = preference.conversations(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    pairs = preference.format_pairs(preference.swapped_replies(talks))
    return pairs.select("conv_id", "n_shared", "prompt", "chosen_completion", _spans("chosen_mask").alias("chosen_mask"),
                        "rejected_completion", _spans("rejected_mask").alias("rejected_mask"))


@query()
def op5_compression_bands(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.compression_bands(docs, "text", carry=["doc_id"])
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                        "doc_ratio", "n_chunks", "n_bad_chunks")


@query()
def op6_best_fit_bins(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", F.regexp_count("text", F.lit(WORD)).alias("n_words"), F.md5("text").alias("cluster"))
    return packing.pack(docs, "doc_id", F.col("n_words"), "source", F.col("cluster"), capacity=2048)


MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@query()
def op7_piece_codec(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = pieces.encode(docs, "text", MODEL, check=True)
    decoded = pieces.decode(encoded, "ids", MODEL)
    return decoded.select("doc_id", F.size("ids").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"), "parity",
                          F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


@query("""
WITH rows AS (
  SELECT page_id, url, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM rows)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to, url
FROM firsts""")
def op8_zip_archives(spark, sf_dir):
    scratch = Scratch(spark)
    archives = warc.write_archives(table(spark, sf_dir, "pages"), f"{scratch.root}/archives")
    return warc.read_records(warc.read_index(archives), payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


@query("""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
    ELSE list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4]) END) AS s FROM words),
shingles AS (SELECT doc_id, hash(unnest(s)) AS h FROM sets),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
met AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM shingles a JOIN shingles b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM met JOIN sizes p ON x = p.doc_id JOIN sizes q ON y = q.doc_id WHERE 100 * shared >= 75 * (p.n + q.n - shared)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, edges.y FROM reach JOIN edges ON reach.y = edges.x)
SELECT sizes.doc_id, n AS n_shingles, min(y) AS component_id FROM sizes JOIN reach ON sizes.doc_id = reach.x GROUP BY ALL""")
def op9_jaccard_groups(spark, sf_dir):
    found = jaccard.similar_groups(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text")
    return found.withColumnRenamed("id", "doc_id")


@query()
def op10_graph_neighbours(spark, sf_dir):
    found = neighbours.nearest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", F.col("vec_id") % 50 == 0, k=5)
    return found.withColumnRenamed("id", "vec_id")


@query(f"""
WITH {CRC_SQL}
talks AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 's': coalesce(text, '')}} ORDER BY turn NULLS FIRST,
                       md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
lengths AS (
  SELECT conv_id, turns, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(conv_id::VARCHAR, '.'), lambda d: ord(d)::BIGINT)),
                                         lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295)::BIGINT % 9 AS h
  FROM talks, crc_table),
rebuilt AS (
  SELECT a.conv_id, list_concat(CASE WHEN b.conv_id IS NULL THEN [] ELSE b.turns[1:a.h] END, a.turns[a.h + 1:]) AS turns
  FROM lengths a LEFT JOIN talks b ON b.conv_id = a.conv_id - a.conv_id % 5),
prefixes AS (SELECT conv_id, len(turns) AS total, d.depth, turns[1:d.depth] AS p FROM rebuilt, LATERAL (SELECT unnest(range(0, len(turns) + 1)) AS depth) d),
nodes AS (
  SELECT p, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CASE WHEN total = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
  FROM prefixes GROUP BY p, depth),
families AS (SELECT p[1:depth - 1] AS p, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (
  SELECT n.*, coalesce(f.n_children, 0) AS n_children,
         CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * octet_length(encode(n.p[depth].s)) END AS saved
  FROM nodes n LEFT JOIN families f ON f.p = n.p),
lines AS (SELECT c.p[1:d.up] AS p, c.n_children, c.saved FROM counted c, LATERAL (SELECT unnest(range(0, c.depth + 1)) AS up) d),
sums AS (SELECT p, count_if(n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM lines GROUP BY p)
SELECT c.conv_id, c.depth, up.conv_id AS parent_conv_id, c.n_convs, c.n_children, s.n_leaves, s.saved_tokens, c.ends_sha256
FROM counted c JOIN sums s ON s.p = c.p LEFT JOIN counted up ON c.depth > 0 AND up.p = c.p[1:c.depth - 1]""")
def op11_truncation_trie(spark, sf_dir):
    talks = trie.conversations(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")
    return trie.prefix_nodes(trie.borrow_openings(talks))


@query()
def op12_fuzzy_notices(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = notices.license_scan(docs, "text", carry=["doc_id"])
    place = F.transform("spans", lambda s: F.format_string("%s:%d-%d:%d", s["label"], s["first"], s["last"], s["errors"]))
    return found.withColumn("spans", F.array_join(place, ","))


@query("""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, g, count(*) AS f FROM (
    SELECT lang, unnest(w) AS g FROM words
    UNION ALL SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
    UNION ALL SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words)
  GROUP BY ALL),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
phrases AS (SELECT lang, g AS phrase, f AS a, string_split(g, ' ') AS p FROM grams WHERE f >= 10 AND contains(g, ' ')),
covers AS (
  SELECT lang, unnest([p[1] || ' ' || p[2], p[2] || ' ' || p[3]]) AS phrase, a AS longer FROM phrases WHERE len(p) = 3),
most AS (SELECT lang, phrase, max(longer) AS longer FROM covers GROUP BY ALL),
kept AS (SELECT x.* FROM phrases x LEFT JOIN most m USING (lang, phrase) WHERE m.longer IS NULL OR 100 * m.longer < 50 * a),
cuts AS (
  SELECT lang, phrase, a, k, array_to_string(p[1:k], ' ') AS head, array_to_string(p[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, len(p))) AS k FROM kept)),
scored AS (
  SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN grams x ON c.lang = x.lang AND c.head = x.g JOIN grams y ON c.lang = y.lang AND c.rest = y.g),
chosen AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM chosen)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""")
def op13_graph_collocations(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("text", "lang")
    return collocations.collocations(docs, "text", "lang")
