"""Secret scans: known shapes of credentials, and character runs of high entropy.

Four kinds of shapes and runs are looked for in a text:

``assign``, ``access``, ``hex``
    A password-like name with a value, an access key id, a long hexadecimal run.
``entropy_hex``, ``entropy_base64``
    Parts of a candidate run whose Shannon entropy within a window of fixed width
    reaches the bound of its character class. The window slides by one character;
    two counts change at each step and the sum over the counts is corrected by
    their two differences. An allow list keeps runs out that are an identifier, a path or
    a plain word as a whole, and stretches that hold a placeholder.

Positions are code points. A null text counts as empty; an empty text has no spans.
Everything is built from SQL functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The shapes of the base kinds.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_VALUE = 8

#: Width of the entropy window, in characters.
WINDOW = 20
#: The classes, with their alphabets and the entropy in bits a window must reach.
CLASSES = {
    "entropy_hex": ("[0-9A-Fa-f]", "0123456789abcdefABCDEF", 3.3),
    "entropy_base64": (
        "[A-Za-z0-9+/_=-]",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-",
        3.9,
    ),
}
KINDS = ["assign", "access", "hex", *CLASSES]

#: Candidate runs that are one of these as a whole are no secrets: words, numbers, paths of words, identifiers, rules.
ALLOWED = [
    r"^[A-Za-z]+$",
    r"^[0-9]+$",
    r"^[A-Za-z]+([-_/][A-Za-z]+)+/?$",
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^[-_=+/]+$",
]
#: A hot stretch that holds one of these is a placeholder; other stretches of its run are judged by themselves.
PLACEHOLDER = r"(?i)example|placeholder|sample|dummy|changeme|xxxx"

#: Counts enter the entropy as n * log2(n), kept in millionths so that sums are exact.
SCALE = 1_000_000
_TERMS = [0, *(round(n * math.log2(n) * SCALE) for n in range(1, WINDOW + 1))]

_SPAN = "struct<start:int,kind:int,end:int>"


def _none() -> Column:
    return F.array().cast(f"array<{_SPAN}>")


#: Elements that one fold appends to an array. Longer arrays are folded in blocks, as each append copies its array.
BLOCK = 128
#: Windows that one fold slides over; longer runs are cut into such pieces.
PIECE = 2_048


def _let(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _in_blocks(values: Column) -> Column:
    """The elements of an array in arrays of BLOCK."""
    count = F.ceil(F.size(values) / BLOCK).cast("int")
    return F.when(
        F.size(values) > 0,
        F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.slice(values, i * BLOCK + 1, F.lit(BLOCK))),
    )


def _folded(values: Column, start: Column, op) -> Column:
    """Running results of ``op`` over a short array."""
    zero = F.struct(start.alias("at"), F.array().cast("array<int>").alias("all"))
    return F.aggregate(
        values,
        zero,
        lambda state, x: _let(
            op(state["at"], x), lambda at: F.struct(at.alias("at"), F.concat(state["all"], F.array(at)).alias("all"))
        ),
        lambda state: state["all"],
    )


def _running(values: Column, zero: int, op) -> Column:
    """Running results of an associative ``op`` over an array of any length: over its blocks, then within each."""

    def by_blocks(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(zero), op))
        upto = _let(totals, lambda t: _folded(t, F.lit(zero), op))
        before = _let(upto, lambda u: F.concat(F.array(F.lit(zero)), F.slice(u, F.lit(1), F.size(u) - 1)))
        pairs = F.zip_with(blocks, before, lambda b, start: F.struct(b.alias("values"), start.alias("start")))
        return F.flatten(F.transform(pairs, lambda z: _folded(z["values"], z["start"], op)))

    none = F.array().cast("array<int>")
    return _let(values, lambda every: F.when(F.size(every) > 0, _let(_in_blocks(every), by_blocks)).otherwise(none))


def _ends(text: Column, pattern: str) -> Column:
    """Ends of all pieces of the text, each of them a gap followed by a match: running sums of their lengths."""
    sizes = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    return _running(sizes, 0, lambda a, b: a + b)


def _merged(spans: Column) -> Column:
    """Spans, ordered by start, joined where they touch or overlap, as structs (start, end)."""

    def joined(x: Column) -> Column:
        far = F.lit(2**31 - 1)
        upto = _running(F.transform(x, lambda s: s["end"]), -1, lambda a, b: F.greatest(a, b))
        starts = F.transform(x, lambda s: s["start"])

        def cut(reach: Column) -> Column:
            before = F.concat(F.array(F.lit(-1)), F.slice(reach, F.lit(1), F.size(reach) - 1))
            after = F.concat(F.slice(starts, F.lit(2), F.size(reach)), F.array(far))
            opens = F.filter(F.zip_with(starts, before, lambda s, e: F.when(s > e, s)), lambda s: s.isNotNull())
            closes = F.filter(F.zip_with(reach, after, lambda e, s: F.when(s > e, e)), lambda e: e.isNotNull())
            return F.zip_with(opens, closes, lambda s, e: F.struct(s.alias("start"), e.alias("end")))

        return F.when(F.size(x) > 0, _let(upto, cut)).otherwise(F.array().cast("array<struct<start:int,end:int>>"))

    return _let(spans, joined)


def _matches(text: Column, body: str, value_group: str | None = None) -> Column:
    """Leftmost matches as structs of start, end and the match or its value.

    Each piece is the shortest gap before a match, with the match. The last piece
    runs to the end of the text and holds no match, so every character is passed once.
    """
    pattern = rf"(?s)(.*?)({body}|\z)"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
    values = found if value_group is None else F.regexp_extract_all(text, F.lit(pattern), F.lit(3))
    return F.transform(
        F.arrays_zip(
            _ends(text, pattern).alias("end"), found.alias("text"), values.alias("value")
        ),
        lambda m: F.struct(
            (m["end"] - F.length(m["text"])).alias("start"),
            m["end"].alias("end"),
            m["text"].alias("text"),
            m["value"].alias("value"),
        ),
    )


def _spans(kind: str, matches: Column) -> Column:
    return F.transform(
        matches,
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end")
        ),
    )


def _base(text: Column, kind: str, body: str, gate: Column, least: int, group: str | None) -> Column:
    matches = F.filter(_matches(text, body, group), lambda m: F.length(m["value"]) >= least)
    return F.when(gate, _spans(kind, matches)).otherwise(_none())


def _windows(run: Column, alphabet: str, bound: float) -> Column:
    """Hot stretches of a piece of a run: (start, end) pairs, relative to it, windows merged.

    State: counts by character, the exact sum of n * log2(n) over them, and the
    stretches so far. Entropy is log2(width) minus that sum over the width.
    """
    most = math.floor((math.log2(WINDOW) - bound) * WINDOW * SCALE)
    terms = F.array(*(F.lit(t) for t in _TERMS))
    symbols = F.split(F.lit(alphabet), "")
    chars = F.split(run, "")
    first = F.slice(chars, 1, WINDOW)
    counts = F.transform(
        symbols, lambda s: F.size(F.filter(first, lambda c: c == s))
    )
    total = F.aggregate(
        counts, F.lit(0), lambda sum_, n: sum_ + F.element_at(terms, n + 1)
    )
    pair = "array<struct<start:int,end:int>>"

    def extended(out: Column, at: Column, sum_: Column) -> Column:
        """Merge the window starting at ``at`` into the stretches if it is hot."""
        end = (at + WINDOW).cast("int")
        last = F.try_element_at(out, F.lit(-1))
        merged = F.concat(
            F.slice(out, F.lit(1), F.size(out) - 1), F.array(F.struct(last["start"].alias("start"), end.alias("end")))
        )
        fresh = F.concat(out, F.array(F.struct(at.cast("int").alias("start"), end.alias("end"))))
        return F.when(sum_ > most, out).when((F.size(out) > 0) & (last["end"] >= at), merged).otherwise(fresh)

    empty = F.array().cast(pair)
    start = F.struct(counts.alias("counts"), total.alias("sum"), extended(empty, F.lit(0), total).alias("out"))
    steps = F.transform(
        F.arrays_zip(
            F.slice(chars, F.lit(1), F.size(chars) - WINDOW).alias("gone"),
            F.slice(chars, F.lit(WINDOW + 1), F.size(chars) - WINDOW).alias("come"),
        ),
        lambda z, i: F.struct(
            (i + 1).alias("at"),
            F.array_position(symbols, z["gone"]).cast("int").alias("gone"),
            F.array_position(symbols, z["come"]).cast("int").alias("come"),
        ),
    )

    def step(state: Column, z: Column) -> Column:
        same = z["gone"] == z["come"]
        old = F.element_at(state["counts"], z["gone"])
        new = F.element_at(state["counts"], z["come"])
        change = (
            F.element_at(terms, old) - F.element_at(terms, old + 1)
            + F.element_at(terms, new + 2) - F.element_at(terms, new + 1)
        )
        sum_ = F.when(same, state["sum"]).otherwise(state["sum"] + change)
        moved = F.transform(
            state["counts"],
            lambda n, i: n - F.when(i + 1 == z["gone"], 1).otherwise(0)
            + F.when(i + 1 == z["come"], 1).otherwise(0),
        )
        return F.struct(
            F.when(same, state["counts"]).otherwise(moved).alias("counts"),
            sum_.alias("sum"),
            extended(state["out"], z["at"], sum_).alias("out"),
        )

    return F.aggregate(steps, start, step, lambda state: state["out"])


def _stretches(run: Column, alphabet: str, bound: float) -> Column:
    """Hot stretches of a run of any length: those of its pieces, joined. Each window lies in one piece."""
    windows = F.length(run) - WINDOW + 1

    def of_piece(at: Column) -> Column:
        part = F.substring(run, at + 1, F.lit(PIECE + WINDOW - 1))
        hot = _let(part, lambda p: _windows(p, alphabet, bound))
        return F.transform(
            hot, lambda w: F.struct((at + w["start"]).alias("start"), (at + w["end"]).alias("end"))
        )

    return _merged(F.flatten(F.transform(F.sequence(F.lit(0), windows - 1, F.lit(PIECE)), of_piece)))


def _entropy(text: Column, kind: str) -> Column:
    chars, alphabet, bound = CLASSES[kind]
    body = rf"{chars}{{{WINDOW},}}"
    runs = F.filter(_matches(text, body), lambda m: (m["end"] > m["start"]) & ~_allowed(m["text"]))
    hot = F.flatten(
        F.transform(
            runs,
            lambda m: F.transform(
                F.filter(
                    _stretches(m["text"], alphabet, bound),
                    lambda w: ~F.substring(m["text"], w["start"] + 1, w["end"] - w["start"]).rlike(PLACEHOLDER),
                ),
                lambda w: F.struct(
                    (m["start"] + w["start"]).alias("start"),
                    F.lit(KINDS.index(kind)).alias("kind"),
                    (m["start"] + w["end"]).alias("end"),
                ),
            ),
        )
    )
    return F.when(text.rlike(body), hot).otherwise(_none())


def _allowed(value: Column) -> Column:
    found = F.lit(False)
    for pattern in ALLOWED:
        found = found | value.rlike(pattern)
    return found


def secret_spans(text: Column) -> Column:
    """All spans of a text as an array of (start, kind, end), ordered by start, then kind."""
    text = F.coalesce(text, F.lit(""))
    low_gate = text.rlike(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]""")
    parts = [
        _base(text, "assign", ASSIGN, low_gate, ASSIGN_VALUE, "value"),
        _base(text, "access", ACCESS, text.contains("AKIA"), 1, None),
        _base(text, "hex", HEX, text.rlike(HEX), 1, None),
        *(_entropy(text, kind) for kind in CLASSES),
    ]
    return F.array_sort(F.concat(*parts))


def find_secrets(docs: DataFrame, text: str = "text", name: str = "secret_spans") -> DataFrame:
    """Add the spans of secrets to every row, as an array of structs in column ``name``."""
    return docs.withColumn(name, secret_spans(F.col(text)))


def redact(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with every stretch covered by spans replaced by the mask.

    A block of stretches is cut out of the text once and then taken apart, so that no stretch
    walks the text from its beginning.
    """

    def masked(stretches: Column, part: Column, at: Column) -> Column:
        """A part of the text that begins at ``at`` and ends with the last of its stretches."""
        before = F.concat(F.array(at), F.transform(F.slice(stretches, F.lit(1), F.size(stretches) - 1), lambda x: x["end"]))
        return F.array_join(
            F.zip_with(
                stretches,
                before,
                lambda x, end: F.concat(F.substring(part, end - at + 1, x["start"] - end), F.lit(mask)),
            ),
            "",
        )

    def by_blocks(blocks: Column) -> Column:
        ends = F.transform(blocks, lambda b: F.element_at(b, -1)["end"])
        starts = F.concat(F.array(F.lit(0)), F.slice(ends, F.lit(1), F.size(ends) - 1))
        zipped = F.zip_with(blocks, starts, lambda b, at: F.struct(b.alias("b"), at.alias("at")))

        def cut(z: Column) -> Column:
            part = F.substring(text, z["at"] + 1, F.element_at(z["b"], -1)["end"] - z["at"])
            return _let(part, lambda p: masked(z["b"], p, z["at"]))

        rest = F.substring(text, F.element_at(ends, -1) + 1, F.length(text))
        return F.concat(F.array_join(F.transform(zipped, cut), ""), rest)

    return F.when(F.size(spans) > 0, _let(_let(_merged(spans), _in_blocks), by_blocks)).otherwise(text)


def _joined(spans: Column) -> Column:
    names = F.array(*(F.lit(kind) for kind in KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of the spans of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_secrets(docs).select("doc_id", F.col("secret_spans").alias("spans"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long")

    base = F.filter("spans", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )
