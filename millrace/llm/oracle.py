"""The same queries as DuckDB SQL, where SQL can express them."""

from __future__ import annotations

#: White space that separates words: the ASCII kinds alone.
_WHITE = r"[\x20\x09-\x0D]+"
_HAS_WORD = r"[^\x20\x09-\x0D]"

OP10 = rf"""
WITH lines AS (
  SELECT doc_id, line_no, line,
         row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS seq
  FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) AS line_no
    FROM documents
  )
  WHERE regexp_matches(line, '{_HAS_WORD}')
), pairs AS (
  SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY seq) AS next_line,
         len(list_filter(regexp_split_to_array(line, '{_WHITE}'), lambda w: w <> '')) AS n_words,
         row_number() OVER (PARTITION BY line ORDER BY doc_id, seq) AS copy_of_line
  FROM lines
), copies AS (
  SELECT *, row_number() OVER (PARTITION BY line, next_line ORDER BY doc_id, seq) AS copy_of_pair
  FROM pairs
), windows AS (
  SELECT *, next_line IS NOT NULL AND copy_of_pair > 1 AS pair_goes FROM copies
), marked AS (
  SELECT *, (n_words >= 5 AND copy_of_line > 1) OR pair_goes
            OR coalesce(lag(pair_goes) OVER (PARTITION BY doc_id ORDER BY seq), false) AS goes
  FROM windows
), every_line AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS line_no
  FROM documents
), kept AS (
  SELECT e.doc_id, count(*) AS n_lines,
         count(*) FILTER (WHERE coalesce(m.goes, false)) AS n_removed,
         coalesce(string_agg(e.line, chr(10) ORDER BY e.line_no)
                  FILTER (WHERE NOT coalesce(m.goes, false)), '') AS text
  FROM every_line e LEFT JOIN marked m USING (doc_id, line_no)
  GROUP BY e.doc_id
)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(table: str) -> str:
    text = f"translate(coalesce({table}.text, ''), '{_UPPER}', '{_LOWER}')"
    return rf"regexp_extract_all({text}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


OP4 = rf"""
WITH docs AS (SELECT doc_id, {_words("documents")} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words("benchmark")} AS w FROM benchmark),
sized AS (SELECT *, least(len(w), 13) AS k FROM items WHERE len(w) > 0),
places AS (SELECT item, k, w, unnest(range(1, len(w) - k + 2)) AS pos FROM sized),
windows AS (
  SELECT DISTINCT item, k, array_to_string(list_slice(w, pos, pos + k - 1), ' ') AS window_text
  FROM places
), spots AS (
  SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS pos
  FROM docs, (SELECT DISTINCT k FROM windows)
), found AS (
  SELECT s.doc_id, s.pos, s.k, v.item
  FROM spots s JOIN windows v
    ON v.k = s.k AND v.window_text = array_to_string(list_slice(s.w, s.pos, s.pos + s.k - 1), ' ')
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(pos, pos + k)) AS p FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit,
       coalesce(n.n_items, 0) AS n_items, sha256(coalesce(n.names, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM docs d LEFT JOIN hit h USING (doc_id) LEFT JOIN named n USING (doc_id)
"""

_NIBBLE = "(strpos('0123456789abcdef', substr(h, {0}, 1)) - 1)"
_FIVE = (
    f"(({_NIBBLE.format('1 + 5 * i // 4')} * 16 + {_NIBBLE.format('2 + 5 * i // 4')})"
    " >> CAST(3 - 5 * i % 4 AS INTEGER)) & 31"
)

OP6 = f"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages
)
SELECT page_id, strlen(payload) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ({_FIVE}) AS BIGINT), 1)), '')
         AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM payloads
"""

#: CRC-32 of a text as SQL, from the table of the 256 bytes.
_HEX = "(strpos('0123456789ABCDEF', substr(h, {0}, 1)) - 1)"
_BYTE = f"{_HEX.format('2 * i + 1')} * 16 + {_HEX.format('2 * i + 2')}"

OP12 = f"""
WITH steps AS (
  SELECT list_transform(range(256), lambda b: list_reduce(list_concat([b], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab
), docs AS (SELECT doc_id, {_words("documents")} AS w FROM documents),
items AS (SELECT {_words("benchmark")} AS w FROM benchmark),
counted AS (
  SELECT word, sum(s) AS s, sum(t) AS t FROM (
    SELECT unnest(w) AS word, 1 AS s, 0 AS t FROM docs
    UNION ALL SELECT unnest(w), 0, 1 FROM items
  ) GROUP BY word
), hashed AS (
  SELECT word, s, t,
         xor(list_reduce(
           list_concat([4294967295], list_transform(range(len(h) // 2), lambda i: {_BYTE})),
           lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT *, hex(encode(word)) AS h FROM counted), steps
), sums AS (SELECT bucket, sum(s) AS s, sum(t) AS t FROM hashed GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln(
    (CAST(t AS DOUBLE) + 1) * (SELECT CAST(sum(s) AS DOUBLE) + 10000 FROM sums)
    / ((CAST(s AS DOUBLE) + 1) * (SELECT CAST(sum(t) AS DOUBLE) + 10000 FROM sums)))) AS gain
  FROM sums
), weights AS (
  SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight
  FROM (SELECT doc_id, unnest(w) AS word FROM docs)
  JOIN hashed USING (word) JOIN gains USING (bucket)
  GROUP BY doc_id
), scored AS (
  SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((
           CAST(CAST('0x' || substr(sha256('2024:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 8) AS BIGINT)
           AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM docs d LEFT JOIN weights USING (doc_id)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
         count(*) OVER (PARTITION BY n_features >= 20) AS n
  FROM scored
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank
FROM placed
"""

ORACLE: dict[str, str] = {
    "op4_decontamination": OP4,
    "op6_warc": OP6,
    "op10_line_dedup": OP10,
    "op12_resampling": OP12,
}
