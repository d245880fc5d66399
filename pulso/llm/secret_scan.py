"""Secret scan in DataFrame expressions only.

Base detectors are three patterns (assignments to a secret-like name, access key ids and
long hex strings). On top, candidate strings are scanned with a sliding window: the
Shannon entropy of the last ``WINDOW`` characters follows from counts that are updated
by the character that enters and the one that leaves, and is held against the threshold of the candidate's
character class (hex, letters, alphanumeric, base64). The span from the first to the last window
above it is a finding, unless the candidate as a whole is a number, a UUID or a checksum, or it overlaps a base span. Allow-listed words blank only the
piece they stand in (between separators), and runs of one character only themselves, so a key beside them is a candidate of its own. For masking
(``overlaps``) a stretch is kept beside the base spans it overlaps unless one of them covers it.

Positions are code points, end exclusive. They come from the lengths of the pieces between matches,
added up by a scan in blocks, so a text with very many matches stays cheap.

Defined results: NULL and empty texts have no spans; repeated rows repeat; an empty table gives
an empty result. All columns of the input are kept, whatever their names; the added column is named by the caller and takes the place of one of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.letters import quoted

# The base detectors and the least length of the group given with each.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# Shorter runs than these can only fail, and no match starts inside one that would not fail too.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_LEAST = 8

WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
# Bits per character of a window of 20, by class: random hex lies near 3.3, random letters near 4.0, random base64 near 4.1, words near 3.4.
THRESHOLDS = {"hex": 3.0, "letters": 4.05, "alnum": 3.7, "base64": 3.8}
ALLOW_WORDS = ("example", "sample", "dummy", "placeholder", "changeme", "redacted", "yourkey", "yourtoken", "yoursecret", "abcdefgh", "01234567", "12345678")
PIECE = "[A-Za-z0-9+]"
REPEATS = 6
# Candidates that are no secrets as a whole: checksums, UUIDs, numbers and dates.
ALLOW = (
    r"^(?i:sha(1|256|384|512))-",
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$",
    r"^[0-9/_=+-]*$",
)
SCAN_BLOCK = 256

SPAN = "array<struct<start:int, rank:int, end:int>>"


def _scan(values: str, step: str, first: str) -> str:
    """SQL for the running fold of an array of ints, ``first`` included in front of every block.

    Appending to one array would copy it for every element; blocks keep the copies short. The result
    has one value per element: the fold up to and including it.
    """
    fold = lambda xs: (f"aggregate({xs}, array({first}), (acc, x) -> concat(acc, array("  # noqa: E731
                       f"{step.format('element_at(acc, -1)', 'x')})))")
    block = f"slice({values}, b * {SCAN_BLOCK} + 1, {SCAN_BLOCK})"
    runs = f"transform(sequence(0, int((size({values}) - 1) / {SCAN_BLOCK})), b -> {fold(block)})"
    bases = fold(f"transform({runs}, r -> element_at(r, -1))")
    return (f"if(size({values}) = 0, array(), flatten(zip_with({runs}, slice({bases}, 1, size({runs})), "
            f"(r, base) -> transform(slice(r, 2, size(r)), x -> {step.format('x', 'base')}))))")


def _matches(rows: DataFrame, text: str, patterns: dict[str, tuple[str, int]]) -> DataFrame:
    """Adds, for each name, ``__m_name``: array of struct(start, end, match, value) of the leftmost
    non-overlapping matches; the value is the given group."""
    t, none, cols = F.col(text), F.array().cast("array<string>"), {}
    for n, (p, group) in patterns.items():
        # One search decides whether the text is taken apart at all.
        hit = t.rlike(p)
        cols[f"__gap_{n}"] = F.when(hit, F.split(t, p, -1)).otherwise(none)
        cols[f"__hit_{n}"] = F.when(hit, F.regexp_extract_all(t, F.lit(p), F.lit(0))).otherwise(none)
        cols[f"__val_{n}"] = F.when(hit, F.regexp_extract_all(t, F.lit(p), F.lit(group))).otherwise(none) if group else F.col(f"__hit_{n}")
    plain = {c: x for c, x in cols.items() if not c.startswith("__val_") or patterns[c[6:]][1]}
    rows = rows.withColumns(plain)
    rows = rows.withColumns({c: x for c, x in cols.items() if c not in plain})
    rows = rows.withColumns({f"__len_{n}": F.expr(f"zip_with(slice(__gap_{n}, 1, size(__hit_{n})), __hit_{n}, (g, m) -> length(g) + length(m))") for n in patterns})
    rows = rows.withColumns({f"__end_{n}": F.expr(_scan(f"__len_{n}", "{0} + {1}", "0")) for n in patterns})
    return rows.withColumns({f"__m_{n}": F.expr(
        f"transform(arrays_zip(__end_{n}, __hit_{n}, __val_{n}), x -> named_struct('start', x.__end_{n} - length(x.__hit_{n}), "
        f"'end', x.__end_{n}, 'match', x.__hit_{n}, 'value', x.__val_{n}))") for n in patterns})


def entropy_window(candidate: str, thresholds: dict[str, float] = THRESHOLDS, window: int = WINDOW) -> str:
    """SQL for struct(first, last): the stretch of a candidate whose windows reach the class threshold, (-1, -1) if none."""
    n_log_n = lambda c: f"if({c} <= 1, 0D, {c} * log2({c}))"
    at = lambda x: f"if({x} = '', 0, instr('{ALPHABET}', {x}))"
    chars = f"regexp_extract_all({candidate}, '(?s).', 0)"
    pairs = (f"zip_with({chars}, slice(concat(array_repeat('', {window}), {chars}), 1, length({candidate})), "
             f"(i, o) -> named_struct('i', {at('i')}, 'o', {at('o')}))")
    limit = (f"CASE WHEN {candidate} RLIKE '^[0-9a-fA-F]+$' THEN {thresholds['hex']}D "
             f"WHEN {candidate} RLIKE '^[A-Za-z/_=+-]+$' THEN {thresholds['letters']}D "
             f"WHEN {candidate} RLIKE '^[A-Za-z0-9]+$' THEN {thresholds['alnum']}D ELSE {thresholds['base64']}D END")
    entering = "element_at(a.counts, x.i)"
    leaving = "(element_at(a.counts, x.o) + if(x.o = x.i, 1, 0))"
    total = (f"a.total + {n_log_n(f'({entering} + 1)')} - {n_log_n(entering)} + "
             f"if(x.o = 0, 0D, {n_log_n(f'({leaving} - 1)')} - {n_log_n(leaving)})")
    hot = f"a.at + 1 >= {window} AND log2({window}D) - t / {window} >= a.limit"
    counts = "transform(a.counts, (n, j) -> n + if(j + 1 = x.i, 1, 0) - if(j + 1 = x.o, 1, 0))"
    step = (f"transform(array({total}), t -> named_struct('at', a.at + 1, 'limit', a.limit, 'counts', {counts}, 'total', t, "
            f"'first', if(a.first < 0 AND {hot}, a.at + 1 - {window}, a.first), 'last', if({hot}, a.at + 1, a.last)))[0]")
    start = f"named_struct('at', 0, 'limit', {limit}, 'counts', array_repeat(0, {len(ALPHABET)}), 'total', 0D, 'first', -1, 'last', -1)"
    return f"aggregate({pairs}, {start}, (a, x) -> {step}, a -> named_struct('first', a.first, 'last', a.last))"


def _blanked(text: Column, words: tuple[str, ...]) -> Column:
    """The text with spaces in place of pieces that hold an allow-listed word, and of runs of one character."""
    # A piece is looked at from its first character only, so long ones stay cheap.
    allowed = (rf"(?<!{PIECE})(?={PIECE}*?(?i:{'|'.join(words)})){PIECE}+|" if words else "") + rf"([A-Za-z0-9+/_=-])\1{{{REPEATS - 1},}}"
    blanks = F.transform(F.regexp_extract_all(text, F.lit(allowed), F.lit(0)), lambda m: F.repeat(F.lit(" "), F.length(m)))
    whole = F.array_join(F.zip_with(F.split(text, allowed, -1), F.concat(blanks, F.array(F.lit(""))), lambda g, m: F.concat(g, m)), "")
    return F.when(text.rlike(CANDIDATE) & text.rlike(allowed), whole).otherwise(text)


def scan(docs: DataFrame, text: str = "text", out: str = "secrets", allow: tuple[str, ...] = ALLOW, allow_words: tuple[str, ...] = ALLOW_WORDS,
         thresholds: dict[str, float] = THRESHOLDS, overlaps: bool = False) -> DataFrame:
    """``docs`` with ``out``: array of struct(start, rank, end) in order, rank being the place in ``KINDS``.
    ``overlaps`` keeps entropy spans that reach beyond the base spans they overlap."""
    rows = docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("__row"), F.coalesce(F.col(quoted(text)).cast("string"), F.lit("")).alias("__text"))
    rows = rows.withColumn("__open", _blanked(F.col("__text"), allow_words))
    rows = _matches(rows, "__text", {"assign": (ASSIGN, 1), "access": (ACCESS, 0), "hex": (HEX, 0)})
    rows = _matches(rows, "__open", {"entropy": (CANDIDATE, 0)})
    allowed = " OR ".join(f"c.match RLIKE {_quote(p)}" for p in allow) or "false"
    hot = f"transform(array({entropy_window('c.match', thresholds)}), w -> if(w.first < 0, null, named_struct('start', c.start + w.first, 'rank', 3, 'end', c.start + w.last)))[0]"
    base = "transform(__m_{0}, x -> named_struct('start', x.start, 'rank', {1}, 'end', x.end))"
    rows = rows.withColumn("__all", F.array_sort(F.concat(
        F.expr(f"transform(filter(__m_assign, x -> length(x.value) >= {ASSIGN_LEAST}), x -> named_struct('start', x.start, 'rank', 0, 'end', x.end))"),
        F.expr(base.format("access", 1)), F.expr(base.format("hex", 2)),
        F.expr(f"filter(transform(filter(__m_entropy, c -> NOT ({allowed})), c -> {hot}), s -> s IS NOT NULL)"))))
    # An entropy span is dropped if a base span that starts before it reaches into it, or the next span (a base one then) starts inside it.
    rows = rows.withColumn("__base_end", F.expr("transform(__all, s -> if(s.rank = 3, 0, s.end))"))
    rows = rows.withColumn("__base_reach", F.expr(_scan("__base_end", "greatest({0}, {1})", "0")))
    # With overlaps only one within the base spans before it is dropped; one that starts with a base span sorts after it.
    apart = "x.r < x.s.end" if overlaps else "(x.r <= x.s.start AND NOT coalesce(x.n.rank < 3 AND x.n.start < x.s.end, false))"
    kept = F.expr("transform(filter(zip_with(arrays_zip(__all, __base_reach), "
                  f"concat(slice(__all, 2, size(__all)), array(CAST(null AS {SPAN[6:-1]}))), (x, n) -> named_struct('s', x.__all, 'r', x.__base_reach, 'n', n)), "
                  f"x -> x.s.rank < 3 OR {apart}), x -> x.s)")
    spans = F.when(F.size("__all") > 0, kept).otherwise(F.array().cast(SPAN))
    return rows.select(*[F.col("__row").getField(c).alias(c) for c in docs.columns if c != out], spans.alias(out))


def _quote(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def labels(spans: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, mask: str = "[secret]", overlaps: bool = False) -> DataFrame:
    """``docs`` with every found span replaced by ``mask`` (overlapping spans by one); other texts stay as they are."""
    packed = docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"), "text")
    rows = scan(packed, "text", "secrets", overlaps=overlaps).withColumn("ends", F.expr("transform(secrets, s -> s.end)"))
    rows = rows.withColumn("reach", F.expr(_scan("ends", "greatest({0}, {1})", "0")))
    # Before each span stands the text from where the spans before it end; nothing if they reach into it.
    parts = F.expr("zip_with(secrets, concat(array(0), slice(reach, 1, size(reach) - 1)), (s, r) -> "
                   f"if(s.start < r, '', concat(substring(text, r + 1, s.start - r), '{mask}')))")
    found = F.size("secrets") > 0
    rows = rows.withColumn("clean", F.when(found, F.concat(F.array_join(parts, ""), F.expr("substring(text, element_at(reach, -1) + 1)"))).otherwise(F.col("text")))
    changed = {"text": F.col("clean"), "n_chars": F.when(found, F.length("clean").cast("long")).otherwise(F.col("row").getField("n_chars") if "n_chars" in docs.columns else F.lit(None))}
    return rows.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
