"""Queries of the operators, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mobspark.llm import (
    ann, bpe, collocations, langid, lines, mixing, sharding, simhash, spelling, suffixes, token_files, topk, toxicity,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_line_dedup": lines.op1_line_dedup,
        "op2_suffix_dedup": suffixes.op2_suffix_dedup,
        "op3_language_id": langid.op3_language_id,
        "op4_target_mixing": mixing.op4_target_mixing,
        "op5_multi_index_search": ann.op5_multi_index_search,
        "op6_simhash_near_duplicates": simhash.op6_simhash_near_duplicates,
        "op7_threshold_topk": topk.op7_threshold_topk,
        "op8_toxicity": toxicity.op8_toxicity,
        "op9_bpe_encoding": bpe.op9_bpe_encoding,
        "op10_token_files": token_files.op10_token_files,
        "op11_spelling_variants": spelling.op11_spelling_variants,
        "op12_histogram_sharding": sharding.op12_histogram_sharding,
        "op13_collocations": collocations.op13_collocations,
    }


#: The vectors' whole components are doubles here, in which the sums are exact.
THRESHOLD_TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
 r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20"""


#: The CRC-32 of one byte after another; ``crc_steps.t`` holds what each byte value does.
CRC_STEPS = """crc_steps AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
   lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def _crc(text: str) -> str:
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: CAST('0x' || x AS BIGINT))"
    return f"xor(4294967295, list_reduce(list_concat([4294967295], {octets}), lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])))"


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Words that share what is left without one place are one replaced code point apart; a word that is another without one
#: place is one deletion away from it.
SPELLING_VARIANTS = f"""
WITH RECURSIVE {CRC_STEPS},
 runs AS (SELECT doc_id, unnest(regexp_extract_all({LOWER}, '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
 counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY doc_id, run),
 hashed AS (SELECT *, {_crc("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM counted, crc_steps),
 changed AS (SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
 words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM changed WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
 without AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
 pairs AS (
  SELECT a.word, b.word AS other, b.n FROM without a JOIN without b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM without a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM without a JOIN words b ON a.rest = b.word),
 near AS (SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS best, max(n) AS best_n FROM pairs GROUP BY word),
 forms AS (SELECT words.word, CASE WHEN best_n >= 5 * n THEN best END AS form, n, coalesce(n_near, 0) AS n_near,
   CASE WHEN best_n >= 5 * n THEN best_n END AS form_n FROM words LEFT JOIN near ON words.word = near.word),
 ways AS (SELECT word, word AS place, 0 AS step FROM forms
  UNION ALL SELECT ways.word, forms.form, step + 1 FROM ways JOIN forms ON forms.word = ways.place WHERE forms.form IS NOT NULL),
 roots AS (SELECT word, arg_max(place, step) AS root FROM ways GROUP BY word)
SELECT forms.word, form, root, n, n_near, form_n FROM forms JOIN roots ON roots.word = forms.word"""

#: A cut lies at the document whose bytes before it are nearest to the target.
HISTOGRAM_SHARDING = f"""
WITH {CRC_STEPS},
 d AS (SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) + 1 AS BIGINT) AS size, {_crc("coalesce(text, '')")} AS text_crc32
  FROM documents, crc_steps),
 b AS (SELECT *, sum(size) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - size AS below, sum(size) OVER () AS total FROM d),
 ends AS (SELECT below, total FROM b UNION SELECT total, total FROM b),
 cuts AS (SELECT j, first(below ORDER BY abs(8 * below - j * total), below) AS cut FROM ends, range(1, 8) AS r(j) GROUP BY j),
 s AS (SELECT doc_id, size, text_crc32, count(j) AS shard FROM b LEFT JOIN cuts ON cut <= below GROUP BY doc_id, size, text_crc32)
SELECT doc_id, size, text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
 row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM s"""

COLLOCATIONS = rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
 w AS (SELECT lang, list_filter(string_split_regex(piece, '[ \x09]+'), lambda y: y <> '') AS w FROM pieces),
 total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
 grams AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: w[i:i + m - 1])) AS g FROM w, range(1, 4) AS r(m)),
 f AS (SELECT lang, m, g, count(*) AS a FROM grams GROUP BY lang, m, g),
 c AS (SELECT * FROM f WHERE m > 1 AND a >= 10),
 inside AS (
  SELECT lang, g[1:2] AS g, max(a) AS most FROM c WHERE m = 3 GROUP BY ALL
  UNION ALL SELECT lang, g[2:3], max(a) FROM c WHERE m = 3 GROUP BY ALL),
 covered AS (SELECT lang, g, max(most) AS most FROM inside GROUP BY lang, g),
 kept AS (SELECT c.* FROM c LEFT JOIN covered v ON c.lang = v.lang AND c.g = v.g WHERE v.most IS NULL OR 100 * v.most < 50 * c.a),
 cuts AS (SELECT *, unnest(range(1, m)) AS k FROM kept),
 scored AS (SELECT cuts.*, x.a AS l, y.a AS r, CAST(1000000 * CAST(cuts.a AS HUGEINT) * cuts.a // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.g = cuts.g[1:k] JOIN f y ON y.lang = cuts.lang AND y.g = cuts.g[k + 1:cuts.m]),
 lowest AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, score FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
 ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total ON total.lang = ranked.lang WHERE rank <= 2000"""


def oracle_sql() -> dict[str, str]:
    """Learned models, merge rounds, signatures and files have no SQL; those queries are tested against brute force."""
    return {
        "op7_threshold_topk": THRESHOLD_TOPK,
        "op11_spelling_variants": SPELLING_VARIANTS,
        "op12_histogram_sharding": HISTOGRAM_SHARDING,
        "op13_collocations": COLLOCATIONS,
    }
