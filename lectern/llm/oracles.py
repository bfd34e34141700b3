"""Queries of this folder once more, in the SQL of an embedded engine, where SQL can express them.

Licence expressions, entropies, tokens, a trained model, XXH64 and eigenvectors have none; those queries
are tested against brute force.
"""

from __future__ import annotations

from lectern.llm.compression import ENTRIES, PARTS, ROUNDS
from lectern.llm.quality import MAX_REPEAT_PERCENT, MIN_WORDS, PRIOR_DOCUMENTS, RATES, SPREADS, UNITS
from lectern.llm.sharding import BITS

EXACT = r"""
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256
FROM (
  SELECT doc_id, content, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size
  FROM (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS content FROM documents
  )
  WINDOW same AS (PARTITION BY content)
)"""

# The windows of 100 bytes, each with its first start; the runs of bytes that the others cover.
SUFFIXES = """
WITH texts AS (SELECT doc_id, encode(coalesce(text, '')) AS data FROM documents),
sizes AS (SELECT doc_id, data, octet_length(data) AS n_bytes FROM texts),
starts AS (SELECT doc_id, data, unnest(range(n_bytes - 99)) AS pos FROM sizes WHERE n_bytes >= 100),
again AS (
  SELECT doc_id, pos FROM starts
  QUALIFY row_number() OVER (PARTITION BY data[pos + 1 : pos + 100] ORDER BY doc_id, pos) > 1
),
marked AS (
  SELECT doc_id, pos, coalesce(pos > lag(pos) OVER own + 100, true) AS fresh FROM again
  WINDOW own AS (PARTITION BY doc_id ORDER BY pos)
),
runs AS (SELECT doc_id, pos, count_if(fresh) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM marked),
spans AS (SELECT doc_id, min(pos) AS begins, max(pos) + 100 AS ends FROM runs GROUP BY doc_id, run),
gaps AS (
  SELECT doc_id, coalesce(lag(ends) OVER (PARTITION BY doc_id ORDER BY begins), 0) AS begins, begins AS ends FROM spans
  UNION ALL SELECT doc_id, max(ends), max(n_bytes) FROM spans JOIN sizes USING (doc_id) GROUP BY doc_id
),
cut AS (
  SELECT doc_id, string_agg(hex(data[begins + 1 : ends]), '' ORDER BY begins) AS kept
  FROM gaps JOIN sizes USING (doc_id) WHERE ends > begins GROUP BY doc_id
),
totals AS (SELECT doc_id, sum(ends - begins) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id)
SELECT doc_id, n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(CASE WHEN n_removed IS NULL THEN data ELSE unhex(coalesce(kept, '')) END) AS kept_sha256
FROM sizes LEFT JOIN totals USING (doc_id) LEFT JOIN cut USING (doc_id)"""


def quality_sql() -> str:
    def rate(name: str) -> str:
        top, factor, bottom, *_ = RATES[name]
        return f"CASE WHEN {bottom} > 0 THEN {top} * {factor} // {bottom} ELSE 0 END"

    rates = ", ".join(f"('{name}', {rate(name)}, {smallest}, {below})" for name, (*_, smallest, below) in RATES.items())
    low = "CASE WHEN {0} < 16 THEN {0} ELSE ({0} % 16 + 16) << CAST({0} // 16 - 1 AS INT) END"
    return rf"""
WITH texts AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines
  FROM texts
),
places AS (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM split WHERE len(words) > 2),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS times FROM places
),
repeats AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM windows WHERE times > 1
  ) GROUP BY doc_id
),
measured AS (
  SELECT s.doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words,
    CAST(length(regexp_replace(text, '[^A-Z]', '', 'g')) AS BIGINT) AS n_capitals,
    CAST(length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS BIGINT) AS n_letters
  FROM split s LEFT JOIN repeats USING (doc_id)
),
judged AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM measured
),
rates AS (
  SELECT doc_id, lang, source, base_failed, r[1] AS rate, r[2] AS value, r[3] AS smallest, r[4] AS below
  FROM (SELECT *, unnest([{rates}]) AS r FROM judged)
),
sketch AS (
  SELECT lang, source, rate, CASE WHEN value < 16 THEN value
    ELSE (length(bin(value)) - 4) * 16 + (value >> CAST(length(bin(value)) - 5 AS INT)) % 16 END AS bin, count(*) AS n
  FROM rates WHERE NOT base_failed GROUP BY ALL
),
wide AS (
  SELECT lang, rate, bin, CAST(sum(n) * {PRIOR_DOCUMENTS * UNITS} // sum(sum(n)) OVER (PARTITION BY lang, rate) AS BIGINT) AS weight
  FROM sketch GROUP BY lang, rate, bin
),
weighed AS (
  SELECT lang, source, rate, bin, n * {UNITS} AS weight FROM sketch
  UNION ALL
  SELECT g.lang, g.source, w.rate, w.bin, w.weight FROM (SELECT DISTINCT lang, source FROM sketch) g
    JOIN wide w ON g.lang IS NOT DISTINCT FROM w.lang
),
fences AS (
  SELECT lang, source, rate,
    min(CASE WHEN 4 * upto >= total THEN {low.format("bin")} END) AS lower,
    min(CASE WHEN 4 * upto >= 3 * total THEN {low.format("(bin + 1)")} - 1 END) AS upper
  FROM (SELECT *, sum(weight) OVER (PARTITION BY lang, source, rate ORDER BY bin) AS upto,
      sum(weight) OVER (PARTITION BY lang, source, rate) AS total
    FROM (SELECT lang, source, rate, bin, sum(weight) AS weight FROM weighed GROUP BY ALL))
  GROUP BY ALL
),
verdicts AS (
  SELECT doc_id, bool_and(value <= upper + {SPREADS} * greatest(upper - lower, smallest)
    AND (NOT below OR value >= lower - {SPREADS} * greatest(upper - lower, smallest))) AS within
  FROM rates r JOIN fences f
    ON r.lang IS NOT DISTINCT FROM f.lang AND r.source IS NOT DISTINCT FROM f.source AND r.rate = f.rate
  GROUP BY doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(within, false) AS kept
FROM judged LEFT JOIN verdicts USING (doc_id)"""


def crc32_sql(nibbles: str) -> str:
    """The checksum of a blob from its half bytes, high ones first: each step divides four bits."""
    table = []
    for value in range(16):
        for _ in range(4):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    # Low halves come first.
    ordered = f"list_transform(range(len({nibbles})), lambda i: {nibbles}[xor(i, 1) + 1])"
    step = f"xor(c >> 4, list_extract({table}, CAST(xor(c, b) & 15 AS INT) + 1))"
    ones = "CAST(4294967295 AS BIGINT)"
    return f"xor(list_reduce({ordered}, lambda c, b: {step}, {ones}), {ones})"


def hilbert_sql(cells: list[str], rows: str, bits: int = BITS) -> str:
    """``rows`` with the column ``hilbert``, one subquery for each step along the bits."""
    names = [f"x{i}" for i in range(len(cells))]
    start = ", ".join(f"CAST({c} AS BIGINT) AS {n}" for c, n in zip(cells, names, strict=True))
    sql = f"SELECT *, {start} FROM {rows}"
    for bit in reversed(range(1, bits)):
        lower = (1 << bit) - 1
        for name in names:
            isset = f"{name} & {1 << bit} <> 0"
            swap = f"xor(x0, {name}) & {lower}"
            turned = f"CASE WHEN {isset} THEN xor(x0, {lower}) ELSE xor(x0, {swap}) END AS x0"
            if name != "x0":
                turned += f", CASE WHEN {isset} THEN {name} ELSE xor({name}, {swap}) END AS {name}"
            sql = f"SELECT * REPLACE ({turned}) FROM ({sql})"
    for before, name in zip(names, names[1:], strict=False):
        sql = f"SELECT * REPLACE (xor({name}, {before}) AS {name}) FROM ({sql})"
    sql = f"SELECT *, CAST(0 AS BIGINT) AS flip FROM ({sql})"
    for bit in reversed(range(1, bits)):
        flipped = f"CASE WHEN {names[-1]} & {1 << bit} <> 0 THEN xor(flip, {(1 << bit) - 1}) ELSE flip END"
        sql = f"SELECT * REPLACE ({flipped} AS flip) FROM ({sql})"
    places = []
    for bit in range(bits):
        for i, name in enumerate(names):
            place = bit * len(names) + len(names) - 1 - i
            places.append(f"((xor({name}, flip) >> {bit}) & 1) * {1 << place}")
    return f"SELECT *, {' + '.join(places)} AS hilbert FROM ({sql})"


def shards_sql(shards: int) -> str:
    names = ("lang", "source")
    most = (1 << BITS) - 1
    ranks = ",\n".join(
        f"""rank_{n} AS (SELECT {n}, 1 + place * {most} // greatest({most}, total) AS cell_{n}
          FROM (SELECT {n}, row_number() OVER (ORDER BY {n}) - 1 AS place, count(*) OVER () AS total
            FROM (SELECT DISTINCT {n} FROM documents WHERE {n} IS NOT NULL)))"""
        for n in names
    )
    joins = " ".join(f"LEFT JOIN rank_{n} USING ({n})" for n in names)
    cells = [f"coalesce(cell_{n}, 0)" for n in names]
    exponent = "(length(bin(size)) - 1)"
    cells.append(f"least({(1 << BITS) - 1}, {exponent} * 4 + (((size << 2) >> CAST({exponent} AS INT)) & 3))")
    return f"""
WITH texts AS (
  SELECT doc_id, lang, source, encode(coalesce(text, '')) AS data FROM documents
),
halves AS (
  SELECT *, list_transform(string_split(hex(data), ''), lambda h: CAST(instr('123456789ABCDEF', h) AS BIGINT)) AS nibbles
  FROM texts
),
metadata AS (
  SELECT doc_id, lang, source, CAST(octet_length(data) + 16 AS BIGINT) AS size,
    CASE WHEN octet_length(data) = 0 THEN 0 ELSE {crc32_sql("nibbles")} END AS text_crc32
  FROM halves
),
{ranks},
joined AS (SELECT metadata.*, {", ".join(f"cell_{n}" for n in names)}, count(*) OVER () AS total FROM metadata {joins}),
placed AS ({hilbert_sql(cells, "joined")}),
ordered AS (SELECT *, row_number() OVER (ORDER BY hilbert, doc_id, text_crc32) - 1 AS pos FROM placed)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(pos * {shards} // total AS INT) AS shard,
  pos - (pos * {shards} // total * total + {shards - 1}) // {shards} AS slot, CAST(NULL AS INT) AS grown_shard
FROM ordered"""


# Every line with its key and the documents that hold it.
LINES = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place
  FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)
),
keyed AS (
  SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
),
owned AS (SELECT *, length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS lost FROM keyed)
SELECT doc_id, count(*) AS n_lines, CAST(count_if(lost) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM owned GROUP BY doc_id"""


def codes_sql() -> str:
    """All distances of all parts to all entries, round by round."""

    def nearest(book: str) -> str:
        apart = "list_sum(list_transform(list_zip(p.y, b.y), lambda pair: (pair[1] - pair[2]) * (pair[1] - pair[2])))"
        return f"""SELECT r, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d
          FROM (SELECT r, p.part, entry, CAST({apart} AS BIGINT) AS d FROM parts p JOIN {book} b ON p.part = b.part)
          GROUP BY r, part"""

    ctes = []
    for number in range(1, ROUNDS + 1):
        before = f"book{number - 1}"
        ctes.append(f"""near{number} AS ({nearest(before)}),
sums{number} AS (
  SELECT part, entry, place, sum(value) AS total, count(*) AS n
  FROM (SELECT part, entry, unnest(y) AS value, generate_subscripts(y, 1) AS place FROM parts JOIN near{number} USING (r, part))
  GROUP BY ALL
),
means{number} AS (
  SELECT part, entry, list((total - (total % n + n) % n) // n ORDER BY place) AS y FROM sums{number} GROUP BY ALL
),
book{number} AS (
  SELECT part, entry, coalesce(m.y, b.y) AS y FROM {before} b LEFT JOIN means{number} m USING (part, entry)
)""")
    last = f"book{ROUNDS}"
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x,
    row_number() OVER (ORDER BY vec_id) AS r
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
),
parts AS (
  SELECT r, part, x[part * len(x) // {PARTS} + 1 : (part + 1) * len(x) // {PARTS}] AS y
  FROM kept, (SELECT unnest(range({PARTS})) AS part)
),
book0 AS (SELECT part, r - 1 AS entry, y FROM parts WHERE r <= {ENTRIES}),
{", ".join(ctes)},
coded AS ({nearest(last)}),
codes AS (
  SELECT r, string_agg(lower(lpad(hex(entry), 2, '0')), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM coded GROUP BY r
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(value AS VARCHAR), ',' ORDER BY part, entry, place))
   FROM (SELECT part, entry, unnest(y) AS value, generate_subscripts(y, 1) AS place FROM {last})) AS codebooks_sha256
FROM kept JOIN codes USING (r)"""


def oracles(shards: int) -> dict[str, str]:
    return {
        "op2_exact_dedup": EXACT,
        "op5_hilbert_shards": shards_sql(shards),
        "op7_quality": quality_sql(),
        "op8_suffix_dedup": SUFFIXES,
        "op11_vector_codes": codes_sql(),
        "op12_line_dedup": LINES,
    }
