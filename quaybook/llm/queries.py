"""Queries of the corpus operators, and their DuckDB oracles where SQL can say it."""

from __future__ import annotations

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaybook.llm import bpe, langid, media, warc
from quaybook.llm.common import documents, small_batches, table
from quaybook.llm.line_dedup import dedup_lines
from quaybook.llm.mixing import BLOCK, PERIOD, mix_sources
from quaybook.llm.near_dedup import classes
from quaybook.llm.packing import pack_examples
from quaybook.llm.phrases import phrases
from quaybook.llm.pii import find_pii
from quaybook.llm.prefix_trie import prefix_trie, rebuilt, turn_lists
from quaybook.llm.repetition import DUP_LINE_CHARS, DUP_LINE_SHARE, DUP_NGRAM, TOP_NGRAM, repetition
from quaybook.llm.suffix_dedup import dedup_substrings


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, from a model of the documents that are not held out."""
    docs = documents(spark, sf_dir)
    found = langid.identify(docs.select("doc_id", "text"), langid.fit(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op2_png_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text as a PNG, read back: digests and cosine hash."""
    return media.read_media(media.with_png(documents(spark, sf_dir))).drop("error")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes under strings of 400 bytes that begin elsewhere, too."""
    found = dedup_substrings(documents(spark, sf_dir))
    # a run may begin or end inside a character: what is left of it reads as replacement characters in `text`
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", F.make_valid_utf8(F.col("kept").cast("string")).alias("text"), "spans")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a WARC record, written to bundles and read back."""
    small_batches(spark)
    bundles = table(warc.write_bundles(warc.with_responses(spark.read.parquet(f"{sf_dir}/pages.parquet"))), "warc")
    return warc.read_bundles(bundles).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's word and repetition counts, and the verdict of the rules."""
    return repetition(documents(spark, sf_dir))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of near-duplicates."""
    return classes(documents(spark, sf_dir)).select("doc_id", "class_id", "class_rows")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids and its decoded text, as digests."""
    path = tokenizer_path("byte_bpe_50k.json")
    return bpe.digests(bpe.encode_texts(documents(spark, sf_dir), path), path)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's personal data, plain and disguised."""
    return find_pii(documents(spark, sf_dir))


def op9_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's block, slot and position in the mix of the sources."""
    return mix_sources(documents(spark, sf_dir).select("doc_id", "source")).select("doc_id", "source", "block", "slot", "position")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without its source's boilerplate lines."""
    return dedup_lines(documents(spark, sf_dir).select("doc_id", "source", "text")).select("doc_id", "n_lines", "n_dropped", "text")


def op11_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of at most 4096 tokens."""
    return pack_examples(documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"), with_ids=False)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of the rebuilt conversations."""
    nodes = prefix_trie(rebuilt(turn_lists(spark.read.parquet(f"{sf_dir}/conversations.parquet"))))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every language's first 2000 phrases."""
    return phrases(documents(spark, sf_dir))


LINE_DEDUP_SQL = """
WITH lines AS (SELECT source, unnest(list_distinct(list_filter(string_split(text, chr(10)), lambda x: trim(x) <> ''))) AS line FROM {docs}),
pages AS (SELECT source, count(*) AS pages FROM {docs} GROUP BY source),
counted AS (SELECT source, line, count(*) AS n FROM lines GROUP BY source, line),
bad AS (SELECT c.source, list(c.line) AS bad FROM counted c JOIN pages p ON c.source IS NOT DISTINCT FROM p.source
        WHERE c.n >= 3 AND c.n > 0.1 * p.pages GROUP BY c.source),
split AS (SELECT d.*, string_split(d.text, chr(10)) AS all_lines,
                 list_filter(string_split(d.text, chr(10)), lambda x: trim(x) = '' OR NOT list_contains(coalesce(b.bad, []::VARCHAR[]), x)) AS kept
          FROM {docs} d LEFT JOIN bad b ON d.source IS NOT DISTINCT FROM b.source)
"""

OP10_SQL = LINE_DEDUP_SQL.format(docs="documents") + """
SELECT doc_id, coalesce(len(all_lines), 0)::BIGINT AS n_lines, (coalesce(len(all_lines), 0) - coalesce(len(kept), 0))::BIGINT AS n_dropped,
       CASE WHEN text IS NOT NULL THEN array_to_string(kept, chr(10)) END AS text
FROM split
"""

#: Walks the slots one by one; the query folds an array and then reckons.
OP9_SQL = f"""
WITH RECURSIVE counts AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
shares AS (SELECT source, n, greatest(1, CAST(round({PERIOD} * sqrt(n) / (SELECT sum(sqrt(n)) FROM counts)) AS BIGINT)) AS k FROM counts),
blocks AS (SELECT source, n, k, (SELECT sum(k) FROM shares)::BIGINT AS p FROM shares),
slots AS (
    SELECT -1::BIGINT AS t, NULL::VARCHAR AS source, 0::BIGINT AS turn, map_from_entries(list((coalesce('=' || source, ''), 0::BIGINT))) AS had FROM blocks
    UNION ALL
    SELECT s.t + 1, x.name, s.had[x.name],
           map_from_entries(list_transform(map_entries(s.had), lambda e: (e.key, e.value + CASE WHEN e.key = x.name THEN 1 ELSE 0 END)))
    FROM slots s, LATERAL (
        SELECT arg_min(name, (due, name)) AS name FROM (
            SELECT coalesce('=' || b.source, '') AS name, (((s.had[coalesce('=' || b.source, '')] + 1) * b.p + b.k - 1) // b.k) AS due
            FROM blocks b WHERE s.had[coalesce('=' || b.source, '')] * b.p < (s.t + 2) * b.k)) x
    WHERE s.t + 1 < (SELECT max(p) FROM blocks)),
ranked AS (
    SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id) - 1 AS r FROM documents),
placed AS (
    SELECT r.doc_id, r.source, r.r, r.r // {BLOCK} AS block, ((r.r // {BLOCK}) // b.k) * b.p + s.t AS slot
    FROM ranked r JOIN blocks b ON r.source IS NOT DISTINCT FROM b.source
    JOIN slots s ON s.source = coalesce('=' || r.source, '') AND s.turn = (r.r // {BLOCK}) % b.k)
SELECT doc_id, source, block::BIGINT AS block, slot::BIGINT AS slot,
       (row_number() OVER (ORDER BY slot, r) - 1)::BIGINT AS position
FROM placed
"""

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_png_media": op2_png_media,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_warc": op4_warc,
    "op5_repetition": op5_repetition,
    "op6_near_dedup": op6_near_dedup,
    "op7_bpe": op7_bpe,
    "op8_pii": op8_pii,
    "op9_pfair_mix": op9_pfair_mix,
    "op10_line_dedup": op10_line_dedup,
    "op11_vector_packing": op11_vector_packing,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_phrases": op13_phrases,
}

#: SHA-1 in base32: the digest's hex digits, padded to 40 bits, five bits at a time.
OP4_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
first AS (SELECT d, min(page_id) AS first FROM p GROUP BY d),
bits AS (SELECT d, list_reduce(list_transform(string_split(d, ''), lambda h: lpad(to_binary(strpos('0123456789abcdef', h) - 1), 4, '0')), lambda a, b: a || b) AS b FROM first)
SELECT p.page_id, p.n::BIGINT AS payload_bytes,
       list_reduce(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_reduce(list_transform(range(5), lambda j: CASE WHEN substr(b, CAST(i * 5 + j + 1 AS BIGINT), 1) = '1' THEN CAST(16 // (1 << j) AS BIGINT) ELSE 0::BIGINT END), lambda x, y: x + y), 1)), lambda x, y: x || y) AS payload_digest,
       CASE WHEN p.page_id = f.first OR f.first IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN p.page_id = f.first THEN NULL ELSE f.first END AS refers_to
FROM p JOIN first f USING (d) JOIN bits USING (d)
"""

_LENGTHS = range(2, max(DUP_NGRAM) + 1)
_GRAMS = " UNION ALL ".join(f"SELECT d, i, {n} AS n, {" || ' ' || ".join(f'w{j}' for j in range(n))} AS g FROM seq WHERE w{n - 1} IS NOT NULL" for n in _LENGTHS)
_LEADS = ", ".join(f"lead(word, {j}) OVER t AS w{j}" for j in range(max(_LENGTHS)))
_TOPS = "".join(f", coalesce(max(top) FILTER (n = {n}), 0) / greatest(1, any_value(word_chars)) AS top_{n}gram_chars" for n in TOP_NGRAM)
_DUPS = "".join(f", coalesce(sum(c) FILTER (n = {n}), 0) / greatest(1, any_value(word_chars)) AS dup_{n}gram_chars" for n in DUP_NGRAM)
_BOUNDS = {"dup_line_share": DUP_LINE_SHARE, "dup_line_chars": DUP_LINE_CHARS} | {f"top_{n}gram_chars": x for n, x in TOP_NGRAM.items()} | {f"dup_{n}gram_chars": x for n, x in DUP_NGRAM.items()}

#: Spells out every window of words, where the operator hashes them.
OP5_SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, coalesce(text, '') AS text FROM documents),
told AS (SELECT d, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM docs),
sizes AS (SELECT d, doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                 len(lines)::BIGINT AS n_lines, len(list_distinct(lines))::BIGINT AS n_first, length(array_to_string(lines, ''))::BIGINT AS line_chars, length(array_to_string(list_distinct(lines), ''))::BIGINT AS first_chars FROM told),
spread AS (SELECT d, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM told),
seq AS (SELECT d, i, length(word) AS c, {_LEADS} FROM spread WINDOW t AS (PARTITION BY d ORDER BY i)),
grams AS ({_GRAMS}),
twice AS (SELECT d, n, g, count(*) * length(replace(g, ' ', '')) AS top FROM grams GROUP BY d, n, g HAVING count(*) > 1),
tops AS (SELECT s.d{_TOPS} FROM sizes s LEFT JOIN twice t ON t.d = s.d GROUP BY s.d),
under AS (SELECT DISTINCT d, n, i + unnest(range(n)) AS i FROM grams SEMI JOIN twice USING (d, n, g)),
dups AS (SELECT s.d, count(q.c) FILTER (n = 3)::BIGINT AS n_repeat_words{_DUPS} FROM sizes s LEFT JOIN under u ON u.d = s.d LEFT JOIN seq q ON q.d = u.d AND q.i = u.i GROUP BY s.d),
shares AS (SELECT * EXCLUDE (d, n_lines, n_first, line_chars, first_chars), n_lines - n_first AS n_dup_lines, (n_lines - n_first) / greatest(1, n_lines) AS dup_line_share, (line_chars - first_chars) / greatest(1, line_chars) AS dup_line_chars,
                  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM sizes JOIN tops USING (d) JOIN dups USING (d))
SELECT *, NOT base_failed AND {" AND ".join(f"{c} <= {x}::DOUBLE" for c, x in _BOUNDS.items())} AS kept FROM shares
"""

#: Spells out all beginnings. The digest only orders turns of one number; crc32 goes bit by bit.
OP12_SQL = """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'r': r, 'x': x} ORDER BY turn NULLS FIRST, r, sha256(strlen(r)::VARCHAR || ':' || r || x)) AS turns FROM t GROUP BY conv_id),
crc AS (SELECT conv_id, xor(list_reduce(list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT),
               lambda c, b: list_reduce(range(8), lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END, xor(c, b)), 4294967295::BIGINT), 4294967295::BIGINT) % 9 AS h FROM own),
seqs AS (SELECT o.conv_id, list_concat(coalesce(b.turns, [])[1:h], o.turns[h + 1:]) AS seq FROM own o JOIN crc USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5),
steps AS (SELECT conv_id, unnest(range(len(seq) + 1)) AS d, seq FROM seqs),
nodes AS (SELECT seq[1:d] AS path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, bool_and(len(seq) = d) AS leaf,
                 sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(seq) = d), '')) AS ends_sha256 FROM steps GROUP BY seq[1:d], d),
worth AS (SELECT *, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(path[depth].x) END AS saves FROM nodes),
above AS (SELECT unnest(range(depth + 1)) AS d, path, leaf, saves FROM worth),
trees AS (SELECT path[1:d] AS path, sum(leaf::BIGINT) AS n_leaves, sum(saves) AS saved_tokens FROM above GROUP BY path[1:d]),
kids AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY path[1:depth - 1])
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0)::BIGINT AS n_children, t.n_leaves::BIGINT AS n_leaves, t.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM worth n JOIN trees t ON t.path = n.path LEFT JOIN kids k ON k.path = n.path LEFT JOIN worth p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
"""

#: Counts all windows of words, as strings.
OP13_SQL = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
split AS (SELECT row_number() OVER () AS p, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces),
seq AS (SELECT p, lang, unnest(words) AS w1, generate_subscripts(words, 1) AS i FROM split),
windows AS (SELECT *, lead(w1, 1) OVER t AS w2, lead(w1, 2) OVER t AS w3, lead(w1, 3) OVER t AS w4 FROM seq WINDOW t AS (PARTITION BY p ORDER BY i)),
totals AS (SELECT lang, count(*) AS n FROM seq GROUP BY lang),
grams AS (SELECT lang, [w1] AS g, count(*) AS f FROM windows GROUP BY lang, w1
          UNION ALL SELECT lang, [w1, w2], count(*) FROM windows WHERE w2 IS NOT NULL GROUP BY lang, w1, w2
          UNION ALL SELECT lang, [w1, w2, w3], count(*) FROM windows WHERE w3 IS NOT NULL GROUP BY lang, w1, w2, w3
          UNION ALL SELECT lang, [w1, w2, w3, w4], count(*) FROM windows WHERE w4 IS NOT NULL GROUP BY lang, w1, w2, w3, w4),
often AS (SELECT * FROM grams WHERE f >= 30),
candidates AS (SELECT lang, g, f AS a FROM often WHERE len(g) > 1),
inside AS (SELECT lang, g, a, unnest(range(2, len(g))) AS m FROM candidates),
shorter AS (SELECT lang, g, a, m, unnest(range(1, len(g) - m + 2)) AS i FROM inside),
longer AS (SELECT lang, g[i:i + m - 1] AS g, max(a) AS most FROM shorter GROUP BY lang, g[i:i + m - 1]),
kept AS (SELECT c.* FROM candidates c LEFT JOIN longer o ON o.lang = c.lang AND o.g = c.g WHERE o.most IS NULL OR 100 * o.most < 80 * c.a),
cuts AS (SELECT lang, g, a, unnest(range(1, len(g))) AS k FROM kept),
scored AS (SELECT c.lang, c.g, c.a, c.k, x.f AS l, y.f AS r, ((2000000::HUGEINT * c.a) // (x.f + y.f)::HUGEINT)::BIGINT AS score
           FROM cuts c JOIN often x ON x.lang = c.lang AND x.g = c.g[1:c.k] JOIN often y ON y.lang = c.lang AND y.g = c.g[c.k + 1:]),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1)
SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank, array_to_string(g, ' ') AS phrase, a, l, r, n, score
FROM worst w JOIN totals t ON t.lang = w.lang QUALIFY rank <= 2000
"""

ORACLE_SQL = {
    "op4_warc": OP4_SQL,
    "op5_repetition": OP5_SQL,
    "op9_pfair_mix": OP9_SQL,
    "op10_line_dedup": OP10_SQL,
    "op12_prefix_trie": OP12_SQL,
    "op13_phrases": OP13_SQL,
}
