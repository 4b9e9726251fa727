"""DuckDB SQL for the queries that SQL can express, from the operators' own parameters."""

from __future__ import annotations

from renewline.llm import negatives, packing, periodic, secrets, sharding


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _pieces(name: str, body: str, group: int) -> str:
    """Matches of a pattern as rows (doc_id, start, stop, whole, value), from gaps and matches.

    Every piece is the shortest gap before a match, with the match; the last one has none.
    """
    pattern = _quoted(rf"(?s)(.*?)({body}|\z)")
    return f"""
{name}_cut AS (
  SELECT row, regexp_extract_all(body, {pattern}, 0) AS pieces, regexp_extract_all(body, {pattern}, 2) AS found,
         regexp_extract_all(body, {pattern}, {group}) AS vals
  FROM docs WHERE regexp_matches(body, {_quoted(body)})),
{name}_row AS (
  SELECT row, i, length(pieces[i]) AS size, found[i] AS whole, vals[i] AS val
  FROM {name}_cut, LATERAL (SELECT unnest(range(1, len(pieces) + 1)) AS i)),
{name} AS (
  SELECT row, CAST(sum(size) OVER (PARTITION BY row ORDER BY i) AS BIGINT) AS stop,
         stop - length(whole) AS start, whole, val
  FROM {name}_row)"""


def _hot(name: str, kind: int, bound: float) -> str:
    """Merged windows of high entropy within the runs of a class."""
    w = secrets.WINDOW
    allowed = " OR ".join(f"regexp_matches(whole, {_quoted(p)})" for p in secrets.ALLOWED)
    return f"""
{name}_window AS (
  SELECT row, start AS run, start + i AS pos, whole,
         list_aggregate(string_split(substr(whole, CAST(i + 1 AS INTEGER), {w}), ''), 'entropy') AS bits
  FROM {name}, LATERAL (SELECT unnest(range(0, length(whole) - {w} + 1)) AS i)
  WHERE length(whole) >= {w} AND NOT ({allowed})),
{name}_mark AS (
  SELECT *, CASE WHEN pos <= lag(pos) OVER (PARTITION BY row, run ORDER BY pos) + {w} THEN 0 ELSE 1 END AS opens
  FROM {name}_window WHERE bits >= {bound}),
{name}_part AS (
  SELECT *, sum(opens) OVER (PARTITION BY row, run ORDER BY pos) AS part FROM {name}_mark),
{name}_span AS (
  SELECT row, {kind} AS kind, min(pos) AS start, max(pos) + {w} AS stop FROM {name}_part GROUP BY row, run, part
  HAVING NOT regexp_matches(
    substr(any_value(whole), CAST(min(pos) - run + 1 AS INTEGER), CAST(max(pos) + {w} - min(pos) AS INTEGER)),
    {_quoted(secrets.PLACEHOLDER)}))"""


def secret_scan() -> str:
    classes = list(secrets.CLASSES.items())
    parts = [
        "docs AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS body FROM documents)",
        _pieces("assign", secrets.ASSIGN, 3),
        _pieces("access", secrets.ACCESS, 2),
        _pieces("hexes", secrets.HEX, 2),
    ]
    spans = [
        f"SELECT row, 0 AS kind, start, stop FROM assign WHERE length(val) >= {secrets.ASSIGN_VALUE}",
        "SELECT row, 1, start, stop FROM access WHERE whole <> ''",
        "SELECT row, 2, start, stop FROM hexes WHERE whole <> ''",
    ]
    for i, (kind, (chars, _, bound)) in enumerate(classes, start=3):
        parts += [_pieces(kind, rf"{chars}{{{secrets.WINDOW},}}", 2), _hot(kind, i, bound)]
        spans.append(f"SELECT row, kind, start, stop FROM {kind}_span")
    kinds = "[" + ", ".join(_quoted(k) for k in secrets.KINDS) + "]"
    shown = f"{kinds}[kind + 1] || ':' || start || ':' || stop"
    joined = f"string_agg({shown}, ',' ORDER BY start, kind)"
    return f"""WITH {",".join(parts)},
spans AS ({" UNION ALL ".join(spans)})
SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
       count(*) FILTER (kind = 2) AS n_hex,
       sha256(coalesce({joined} FILTER (kind < 3), '')) AS base_sha256,
       coalesce({joined} FILTER (kind IS NOT NULL), '') AS spans
FROM docs LEFT JOIN spans USING (row) GROUP BY row, doc_id"""


#: CRC-32 of a list of bytes: the usual table, made from its polynomial, applied byte by byte.
_CRC_TABLE = """
crc_table AS (
  SELECT list_transform(range(0, 256), lambda n: list_reduce(list_prepend(n, range(0, 8)),
           lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t)"""


def _crc(bytes_: str) -> str:
    step = "lambda c, b: xor(t[CAST((xor(c, b) & 255) + 1 AS INTEGER)], c >> 8)"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bytes_}), {step}), 4294967295)"


def _bytes(text: str) -> str:
    """UTF-8 bytes of a text, from the code points of its characters."""
    point = f"list_transform(regexp_extract_all({text}, '(?s).'), lambda s: CAST(unicode(s) AS BIGINT))"
    utf8 = (
        "CASE WHEN p < 128 THEN [p] WHEN p < 2048 THEN [192 | (p >> 6), 128 | (p & 63)] "
        "WHEN p < 65536 THEN [224 | (p >> 12), 128 | ((p >> 6) & 63), 128 | (p & 63)] "
        "ELSE [240 | (p >> 18), 128 | ((p >> 12) & 63), 128 | ((p >> 6) & 63), 128 | (p & 63)] END"
    )
    return f"flatten(list_transform({point}, lambda p: {utf8}))"


def _hilbert(source: str) -> str:
    """CTEs that turn columns x0 to x3 of ``source`` into ``hilbert``, one step each."""
    bits, dims = sharding.LEVEL_BITS, 4
    out, last, n = [], source, 0

    def step(columns: dict[int, str], more: str = "") -> None:
        nonlocal last, n
        n += 1
        changed = ", ".join(f"{e} AS x{k}" for k, e in columns.items())
        kept = "* EXCLUDE (" + ", ".join(f"x{k}" for k in columns) + ")" if columns else "*"
        out.append(f"\nstep{n} AS (SELECT {kept}{', ' + changed if changed else ''}{more} FROM {last})")
        last = f"step{n}"

    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(dims):
            isset, differ = f"(x{i} >> {b}) & 1 = 1", f"(xor(x0, x{i}) & {low})"
            columns = {0: f"CASE WHEN {isset} THEN xor(x0, {low}) ELSE xor(x0, {differ}) END"}
            if i:
                columns[i] = f"CASE WHEN {isset} THEN x{i} ELSE xor(x{i}, {differ}) END"
            step(columns)
    for i in range(1, dims):
        step({i: f"xor(x{i}, x{i - 1})"})
    flip = "0"
    for b in range(bits - 1, 0, -1):
        flip = f"xor({flip}, CASE WHEN (x{dims - 1} >> {b}) & 1 = 1 THEN {(1 << b) - 1} ELSE 0 END)"
    step({i: f"xor(x{i}, {flip})" for i in range(dims)})
    terms = [
        f"(CAST((x{i} >> {b}) & 1 AS BIGINT) << {b * dims + dims - 1 - i})" for b in range(bits) for i in range(dims)
    ]
    step({}, f", {' + '.join(terms)} AS hilbert")
    return ",".join(out)


def _last_step() -> str:
    return f"step{(sharding.LEVEL_BITS - 1) * 4 + 3 + 2}"


def hilbert_shards() -> str:
    top, k = 1 << sharding.LEVEL_BITS, sharding.SHARDS
    return f"""WITH {_CRC_TABLE},
raw AS (
  SELECT doc_id, lang, source, CAST(coalesce(strlen(text), 0) + 1 AS BIGINT) AS size,
         {_crc(_bytes("coalesce(text, '')"))} AS text_crc32,
         {_crc(_bytes("lang"))} AS lang_crc, {_crc(_bytes("source"))} AS source_crc, t
  FROM documents, crc_table),
bounds AS (SELECT min(doc_id) AS low, max(doc_id) AS high, count(*) AS n FROM documents),
cells AS (
  SELECT doc_id, size, text_crc32, n, t, coalesce(lang_crc % {top}, 0) AS x0, coalesce(source_crc % {top}, 0) AS x1,
         least(length(bin(size)) - 1, {top - 1}) AS x2,
         coalesce((doc_id - low) * {top} // (high - low + 1), 0) AS x3
  FROM raw, bounds),{_hilbert("cells")},
counted AS (SELECT *, count(*) OVER (PARTITION BY hilbert) AS cell FROM {_last_step()}),
numbered AS (
  SELECT doc_id, size, text_crc32, hilbert, n, row_number() OVER (ORDER BY hilbert,
           {_crc(_bytes("concat_ws('|', doc_id, size, text_crc32)"))} % ((cell + {sharding.ROWS_PER_TASK - 1}) // {sharding.ROWS_PER_TASK}),
           doc_id NULLS FIRST, size, text_crc32) - 1 AS pos
  FROM counted)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(pos * {k} // n AS INTEGER) AS shard,
       pos - (pos * {k} // n * n + {k - 1}) // {k} AS slot, CAST(NULL AS INTEGER) AS grown_shard, hilbert
FROM numbered"""


def length_buckets() -> str:
    """The dynamic program as a recursion over bucket counts, over all lengths that occur.

    The operator joins lengths of 2,048 and more into bins, so this holds where the bins
    above that hold one length each.
    """
    k, budget, part = packing.BUCKETS, packing.BUDGET, packing.ROWS_PER_TASK
    return f"""WITH RECURSIVE {_CRC_TABLE},
counted AS (
  SELECT doc_id, CAST(coalesce(len(regexp_extract_all(text, '[^\\x09-\\x0D\\x20]+')), 0) AS INTEGER) AS n_tokens
  FROM documents),
keyed AS (
  SELECT *, CASE WHEN n_tokens < 2048 THEN 0 ELSE length(bin(n_tokens)) - 11 END AS scale,
         n_tokens >> (CASE WHEN n_tokens < 2048 THEN 0 ELSE length(bin(n_tokens)) - 11 END) AS step FROM counted),
bins AS (
  SELECT CAST(row_number() OVER (ORDER BY max(n_tokens)) AS INTEGER) AS i, max(n_tokens) AS top, count(*) AS n,
         sum(n_tokens) AS tokens FROM keyed GROUP BY scale, step),
sums AS (
  SELECT i, top, sum(n) OVER (ORDER BY i) AS n, sum(tokens) OVER (ORDER BY i) AS tokens FROM bins
  UNION ALL SELECT 0, 0, 0, 0),
-- From j to i in one bucket: padding of the bins j + 1 to i.
best AS (
  SELECT 1 AS k, i, CAST(top * n - tokens AS BIGINT) AS cost, CAST([top] AS INTEGER[]) AS cuts FROM sums WHERE i > 0
  UNION ALL
  SELECT k + 1, i, cost, cuts FROM (
    SELECT b.k, s.i, CAST(b.cost + s.top * (s.n - p.n) - (s.tokens - p.tokens) AS BIGINT) AS cost,
           list_append(b.cuts, s.top) AS cuts,
           row_number() OVER (PARTITION BY b.k, s.i
             ORDER BY b.cost + s.top * (s.n - p.n) - (s.tokens - p.tokens), b.i) AS place
    FROM best b JOIN sums p ON p.i = b.i JOIN sums s ON s.i > b.i WHERE b.k < {k})
  WHERE place = 1),
chosen AS (
  SELECT cuts FROM best WHERE i = (SELECT max(i) FROM bins) ORDER BY k DESC LIMIT 1),
placed AS (
  SELECT doc_id, n_tokens, cuts, CAST(len(list_filter(cuts, lambda c: c < n_tokens)) AS INTEGER) AS bucket
  FROM counted, chosen),
numbered AS (
  SELECT *, cuts[bucket + 1] AS bucket_len, greatest(1, {budget} // greatest(1, cuts[bucket + 1])) AS room,
         row_number() OVER (PARTITION BY bucket ORDER BY
           {_crc(_bytes("concat_ws('|', doc_id, n_tokens)"))} % (((SELECT count(*) FROM counted) + {part - 1}) // {part}),
           doc_id NULLS FIRST, n_tokens) - 1 AS pos
  FROM placed, crc_table)
SELECT doc_id, n_tokens, bucket, bucket_len, bucket_len - n_tokens AS padding,
       CAST(pos // room AS BIGINT) AS batch, CAST(pos % room AS INTEGER) AS slot
FROM numbered"""


#: The words of a text, parted by ASCII white space.
_WORDS = "regexp_extract_all(coalesce({text}, ''), '[^\\x09-\\x0D\\x20]+')"


def periodic_runs() -> str:
    """Runs as islands of places whose word comes again one period on; the smallest period of a stretch counts."""
    least, copies = periodic.MIN_LENGTH, periodic.COPIES
    words = _WORDS.format(text="text")
    return f"""WITH {_CRC_TABLE},
raw AS (
  SELECT row_number() OVER () AS row, doc_id, {words} AS w,
         CASE WHEN doc_id IS NOT NULL THEN {_crc(_bytes("CAST(doc_id AS VARCHAR)"))} END AS h
  FROM documents, crc_table),
sized AS (
  SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a,
         CASE WHEN len(w) > 0 THEN 1 + (len(w) - (h // 10) % len(w)) // (3 + (h // 10) % 8) END AS p FROM raw),
docs AS (
  SELECT row, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN
           list_transform(range(n), lambda i: w[CASE WHEN i < a THEN i + 1 ELSE a + (i - a) % p + 1 END]) ELSE w END AS w
  FROM sized),
words AS (SELECT row, n, unnest(w) AS word, unnest(range(n)) AS i FROM docs),
again AS (
  SELECT x.row, x.i, y.i - x.i AS q FROM words x JOIN words y
    ON x.row = y.row AND x.word = y.word AND y.i > x.i AND {copies} * (y.i - x.i) <= x.n),
marked AS (SELECT *, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS island FROM again),
stretches AS (
  SELECT row, q, min(i) AS start, count(*) + q AS length FROM marked GROUP BY row, q, island
  HAVING count(*) + q >= greatest({least}, {copies} * q)),
runs AS (SELECT row, start, length, min(q) AS period FROM stretches GROUP BY row, start, length),
best AS (
  SELECT row, count(*) AS n_runs, arg_min([start, length, period], [-length, start, period]) AS top,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS shown
  FROM runs GROUP BY row),
kept AS (
  SELECT row, string_agg(word, ' ' ORDER BY i) AS body FROM words
  WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.row = words.row AND i >= r.start + r.period AND i < r.start + r.length)
  GROUP BY row)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, top[1] AS start, top[2] AS length, top[3] AS period,
       1000 * top[2] // top[3] AS exponent_milli, sha256(coalesce(shown, '')) AS runs_sha256,
       sha256(coalesce(body, '')) AS collapsed_sha256
FROM docs LEFT JOIN best USING (row) LEFT JOIN kept USING (row)"""


def hard_negatives() -> str:
    """All products of anchors with all rows, ranked."""
    n = negatives
    return f"""WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({n.SCALE} * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id % {n.ANCHORS_EVERY} = 0 AND a.vec_id <> b.vec_id),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {n.POSITIVES})
SELECT anchor_id, positive_id, CAST(row_number() OVER hard AS INTEGER) AS rank, vec_id AS negative_id, positive_score,
       score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND {n.SHARE} * positive_score <= 100 * score AND score <= positive_score
WINDOW hard AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER hard <= {n.NEGATIVES}"""


ORACLE_SQL = {
    "op1_secret_scan": secret_scan(),
    "op2_hilbert_shards": hilbert_shards(),
    "op4_length_buckets": length_buckets(),
    "op11_periodic_runs": periodic_runs(),
    "op13_hard_negatives": hard_negatives(),
}
