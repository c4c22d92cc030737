"""Secrets in texts: three fixed patterns, and strings that look random.

Whether a run of characters looks random is decided by two character Markov models, one of
random strings and one of ordinary identifiers. The logarithm of the ratio of their
probabilities is summed over the transitions of the run. A run that does not look random
as a whole is searched for the stretches with the greatest sums, because names and paths
stand in one run with the secret behind them; a stretch counts with the letters and
digits that touch it. What a pattern matches is cut out first, and what is left on either
side is judged. Both models are fitted on labelled samples: what the patterns match is
random, other runs of a bounded sample of the texts are ordinary.

Only DataFrame functions are used. A regular expression gives no positions in Spark, but
splitting by it and extracting its matches walk through the text in the same way, so the
lengths of the parts and matches in turn add up to positions, in code points.

Defined results: a null text is empty and has no spans. Without labelled samples both
models are uniform, and no run stands out. Repeated rows give repeated results, texts of
any length are searched whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

# The patterns, in the order in which their kinds are listed. The last two
# have the least length of a span written into them: their character runs cannot be
# matched in parts, so this keeps the same matches.
ASSIGN = (
    r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
PATTERNS = {
    "assign": ASSIGN,
    "access": r"AKIA[A-Z0-9]{12,}",
    "hex": r"[0-9a-f]{32,}",
}
ASSIGNED_CHARACTERS = 8

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN = r"[A-Za-z0-9+/_=-]{%d,}"
STATES = len(ALPHABET) + 1  # 0 stands before the first character

LEARNED_RUN = 6
JUDGED_RUN = 16
SAMPLE_DOCUMENTS = 5_000
SMOOTHING = 0.5
LEAST_TOTAL = 24.0
LEAST_PER_CHARACTER = 1.2
DROP = 8.0  # a stretch ends where its sum has fallen so far below its greatest
MARK = "[SECRET]"

_CHUNK = 256
PLACE = "array<struct<start:bigint,end:bigint>>"
SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"


def _scan_short(values: Column, step, zero: Column) -> Column:
    """``zero`` and the running results of ``step`` over an array; each step copies what it has."""
    return F.aggregate(
        values, F.array(zero), lambda acc, x: F.concat(acc, F.array(step(F.element_at(acc, -1), x)))
    )


def _chunk(values: Column) -> Column:
    """Elements worked on at once: enough that there are not more chunks than elements in one."""
    return F.greatest(F.lit(_CHUNK), F.ceil(F.sqrt(F.size(values))).cast("int"))


def running(values: Column, step, zero: Column) -> Column:
    """For each element the result of the associative ``step`` over those before it.

    A step copies what it has, so arrays are cut into chunks and the results of whole chunks
    are carried over. Everything used twice is computed once: an expression inside a lambda
    function is evaluated for every element.
    """

    def pieces_of(values: Column) -> Column:
        return _once(_chunk(values), lambda size: F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(values) - 1, F.lit(0)), size),
            lambda at: _scan_short(F.slice(values, at + 1, size), step, zero),
        ))

    def joined(pieces: Column) -> Column:
        bases = _scan_short(F.transform(pieces, lambda p: F.element_at(p, -1)), step, zero)
        one = lambda p, base: F.transform(F.slice(p, 1, F.size(p) - 1), lambda x: step(base, x))
        return F.flatten(F.zip_with(pieces, F.slice(bases, 1, F.size(pieces)), one))

    return _once(values, lambda v: _once(pieces_of(v), joined))


def running_sums(lengths: Column) -> Column:
    """Sums of the elements before each element."""
    return running(lengths, lambda a, b: a + b, F.lit(0).cast("bigint"))


def located(text: Column, pattern: str) -> Column:
    """array<struct<start, end, value>> of a pattern's leftmost non-overlapping matches."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    lengths = lambda parts: F.transform(parts, lambda p: F.char_length(p).cast("bigint"))

    def place(found: Column) -> Column:
        # Before match i stand the parts 0 to i and the matches 0 to i - 1.
        parts = F.slice(lengths(F.split(text, pattern, -1)), 1, F.size(found))
        return _once(parts, lambda p: from_parts(found, p))

    def from_parts(found: Column, parts: Column) -> Column:
        ends = running_sums(F.zip_with(parts, lengths(found), lambda p, m: p + m))
        starts = F.zip_with(ends, parts, lambda e, p: e + p)
        return F.zip_with(
            found, starts,
            lambda v, s: F.struct(s.alias("start"), (s + F.char_length(v)).alias("end"), v.alias("value")),
        )

    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    return _once(matches, lambda found: F.when(F.size(found) == 0, none).otherwise(place(found)))


def _once(value: Column, use) -> Column:
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _assigned(value: Column) -> Column:
    return F.regexp_extract(value, ASSIGN, 1)


def base_spans(text: Column) -> Column:
    """The spans of the patterns: array<struct<start, kind, end>>, kinds numbered as listed."""
    every = []
    for number, (kind, pattern) in enumerate(PATTERNS.items()):
        found = located(text, pattern)
        if kind == "assign":
            found = F.filter(found, lambda m: F.char_length(_assigned(m["value"])) >= ASSIGNED_CHARACTERS)
        every.append(_spans(found, number))
    return F.array_sort(F.concat(*every))


def _spans(found: Column, kind: int) -> Column:
    return F.transform(
        found, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"))
    ).cast(SPAN)


def _number_of(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def _transitions(strings: DataFrame) -> DataFrame:
    """(cell, n): how often each character follows another in the strings of column ``s``."""
    code = lambda at: F.instr(F.lit(ALPHABET), F.substring(F.col("s"), at, F.lit(1)))
    cells = F.transform(
        F.sequence(F.lit(1), F.char_length("s")),
        lambda i: F.when(i == 1, F.lit(0)).otherwise(code(i - 1)) * STATES + code(i),
    )
    return strings.where(F.char_length("s") > 0).select(F.explode(cells).alias("cell")).groupBy("cell").agg(
        F.count(F.lit(1)).alias("n")
    )


def _log_probabilities(counts: dict[int, int]) -> list[float]:
    table = []
    for a in range(STATES):
        row = [counts.get(a * STATES + b, 0) for b in range(STATES)]
        total = sum(row) + SMOOTHING * STATES
        table += [math.log((n + SMOOTHING) / total) for n in row]
    return table


def fit(random: DataFrame, ordinary: DataFrame, column: str = "s") -> list[float]:
    """Log-likelihood ratios of all transitions, from labelled strings.

    The driver receives one count for each pair of characters of the alphabet. Other
    characters are left out of the strings.
    """
    tables = []
    for strings in (random, ordinary):
        kept = F.regexp_replace(F.col(f"`{column}`"), r"[^A-Za-z0-9+/_=-]", "")
        found = _transitions(strings.select(kept.alias("s"))).collect()
        tables.append(_log_probabilities({r.cell: r.n for r in found}))
    return [a - b for a, b in zip(*tables)]


def labelled_samples(docs: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> tuple[DataFrame, DataFrame]:
    """Labelled strings of a table (doc_id, text).

    Random: the values that the patterns match, in all texts. Ordinary: all other runs in
    ``sample`` different texts, those with the smallest hashes; copies count once.
    """
    text = F.col("text")
    assigned = F.filter(F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(1)), lambda v: F.char_length(v) >= ASSIGNED_CHARACTERS)
    others = [F.regexp_extract_all(text, F.lit(PATTERNS[k]), F.lit(0)) for k in ("access", "hex")]
    random = docs.select(F.explode(F.concat(assigned, *others)).alias("s"))
    hashed = docs.withColumn("_h", F.xxhash64("text"))
    last = hashed.select("_h").distinct().orderBy("_h").limit(sample).agg(F.max("_h")).first()[0]
    chosen = hashed.where(F.col("_h") <= F.lit(last)).dropDuplicates(["_h"]).select("text")
    rest = text
    for pattern in PATTERNS.values():
        rest = F.regexp_replace(rest, pattern, " ")
    runs = F.regexp_extract_all(rest, F.lit(RUN % LEARNED_RUN), F.lit(0))
    return random, chosen.select(F.explode(runs).alias("s"))


def log_ratio(value: Column, table: list[float]) -> Column:
    """Sum of the ratios over a string's transitions."""
    ratios = F.expr(f"array({', '.join(f'{x!r}D' for x in table)})")
    start = F.struct(F.lit(0).alias("before"), F.lit(0.0).alias("sum"))

    def step(acc: Column, character: Column) -> Column:
        return _once(
            F.instr(F.lit(ALPHABET), character),
            lambda c: F.struct(
                c.alias("before"), (acc["sum"] + F.get(ratios, acc["before"] * STATES + c)).alias("sum")
            ),
        )

    return F.aggregate(F.split(value, ""), start, step, lambda acc: acc["sum"])


def _looks_random(length: Column, total: Column) -> Column:
    least = F.greatest(F.lit(LEAST_TOTAL), length * F.lit(LEAST_PER_CHARACTER))
    return (length >= JUDGED_RUN) & (total >= least)


def random_stretches(value: Column, table: list[float]) -> Column:
    """Places in a string that look random: all of it, or else its stretches.

    A stretch begins where the sum of the ratios was last not positive, and ends at its
    greatest sum, once the sum is used up or has fallen by DROP.
    """
    ratios = F.expr(f"array({', '.join(f'{x!r}D' for x in table)})")
    long = lambda n: F.lit(n).cast("bigint")
    none = F.array().cast(PLACE)
    first = F.struct(
        F.lit(0).alias("before"), long(0).alias("at"), F.lit(0.0).alias("whole"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"),
        long(0).alias("start"), long(0).alias("end"), none.alias("found"),
    )

    def found(acc: Column) -> Column:
        place = F.struct(acc["start"].alias("start"), acc["end"].alias("end"))
        good = _looks_random(acc["end"] - acc["start"], acc["best"])
        return F.when(good, F.concat(acc["found"], F.array(place))).otherwise(acc["found"])

    def add(acc: Column, c: Column, ratio: Column) -> Column:
        now = acc["sum"] + ratio
        closed = (now <= 0) | (acc["best"] - now > DROP)
        here = acc["at"] + 1
        return F.struct(
            c.alias("before"), here.alias("at"), (acc["whole"] + ratio).alias("whole"),
            F.when(closed, 0.0).otherwise(now).alias("sum"),
            F.when(closed, 0.0).otherwise(F.greatest(acc["best"], now)).alias("best"),
            F.when(closed, here).otherwise(acc["start"]).alias("start"),
            F.when(closed | (now > acc["best"]), here).otherwise(acc["end"]).alias("end"),
            F.when(closed, found(acc)).otherwise(acc["found"]).alias("found"),
        )

    def step(acc: Column, character: Column) -> Column:
        code = F.instr(F.lit(ALPHABET), character)
        return _once(code, lambda c: _once(F.get(ratios, acc["before"] * STATES + c), lambda r: add(acc, c, r)))

    length = F.char_length(value).cast("bigint")
    all_of_it = F.array(F.struct(long(0).alias("start"), length.alias("end")))
    return F.aggregate(
        F.split(value, ""), first, step,
        lambda acc: F.when(_looks_random(length, acc["whole"]), all_of_it).otherwise(_once(found(acc), lambda f: _widened(value, f))),
    )


def _widened(value: Column, found: Column) -> Column:
    """Stretches with the letters and digits that touch them, those that meet made one."""
    letters = lambda part: F.char_length(F.regexp_extract(part, "^[A-Za-z0-9]*", 0)).cast("bigint")

    def grown(gaps: Column) -> Column:
        count = F.size(found)
        edges = F.zip_with(
            F.slice(gaps, 1, count), F.slice(gaps, 2, count),
            lambda before, behind: F.struct(letters(F.reverse(before)).alias("before"), letters(behind).alias("behind")),
        )
        wide = F.zip_with(
            found, edges, lambda s, e: F.struct((s["start"] - e["before"]).alias("start"), (s["end"] + e["behind"]).alias("end"))
        )
        return _once(wide, _merged)

    return F.when(F.size(found) == 0, found).otherwise(_once(_between(value, found), grown))


def without(text: Column, spans: Column) -> Column:
    """The text with blanks in place of some spans."""

    def blank(merged: Column) -> Column:
        gaps = F.transform(merged, lambda s: F.repeat(F.lit(" "), (s["end"] - s["start"]).cast("int")))
        return F.array_join(F.zip_with(_between(text, merged), gaps, lambda k, g: F.concat(k, F.coalesce(g, F.lit("")))), "")

    return F.when(F.size(spans) == 0, text).otherwise(_once(_merged(spans), blank))


def random_spans(runs: Column, table: list[float]) -> Column:
    """Spans that look random in some runs, as :func:`located` gives them."""

    def places(m: Column) -> Column:
        return F.transform(
            random_stretches(m["value"], table),
            lambda s: F.struct((m["start"] + s["start"]).alias("start"), (m["start"] + s["end"]).alias("end")),
        )

    return _spans(F.flatten(F.transform(runs, places)), len(PATTERNS))


def with_spans(df: DataFrame, text: str, base: str, every: str, table: list[float] | None = None) -> DataFrame:
    """``df`` with two columns more: the base spans, and all spans, each sorted."""
    filled = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    if table is None:
        table = fit(*labelled_samples(df.select(filled.alias("text"))))
    # One step a column: Spark resolves nested lambda functions one level in each of its passes.
    found, rest = (_spare(df, c) for c in ("runs", "rest"))
    return (
        df.withColumn(base, base_spans(filled))
        .withColumn(rest, without(filled, F.col(f"`{base}`")))
        .withColumn(found, _once(F.col(f"`{rest}`"), lambda t: located(t, RUN % JUDGED_RUN)))
        .withColumn(every, F.array_sort(F.concat(F.col(f"`{base}`"), random_spans(F.col(f"`{found}`"), table))))
        .drop(found, rest)
    )


def _spare(df: DataFrame, name: str) -> str:
    return name if name not in df.columns else _spare(df, name + "_")


def _written(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in [*PATTERNS, "random"]])
    one = lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def scan(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every row."""
    docs = df.select(F.col(f"`{key}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    found = with_spans(docs, "text", "base", "every")
    counts = [_number_of("base", number).alias(f"n_{kind}") for number, kind in enumerate(PATTERNS)]
    return found.select("doc_id", *counts, F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(F.col("every")).alias("spans"))


def _merged(spans: Column) -> Column:
    """Sorted spans with those that overlap made one; ``spans`` is computed once by the caller."""
    reached = running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b), F.lit(-1).cast("bigint"))
    marked = F.zip_with(spans, reached, lambda s, r: F.struct(s["start"].alias("start"), r.alias("reached")))
    # A span that begins where all before it have ended starts a new one, and ends the last.
    firsts = F.filter(marked, lambda m: m["start"] >= m["reached"])

    def closed(firsts: Column) -> Column:
        last = F.array_max(F.transform(spans, lambda s: s["end"]))
        ends = F.concat(F.slice(F.transform(firsts, lambda m: m["reached"]), 2, F.size(firsts)), F.array(last))
        return F.zip_with(firsts, ends, lambda m, e: F.struct(m["start"].alias("start"), e.alias("end")))

    none = F.array().cast(PLACE)
    return F.when(F.size(spans) == 0, none).otherwise(_once(firsts, closed))


def _between(text: Column, merged: Column) -> Column:
    """The parts of a text before, between and behind merged spans, of which there are some."""
    begins = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(merged, lambda s: s["end"]))
    ends = F.concat(F.transform(merged, lambda s: s["start"]), F.array(F.char_length(text).cast("bigint")))
    cuts = F.zip_with(begins, ends, lambda b, e: F.struct(b.alias("start"), e.alias("end")))
    return _once(cuts, lambda c: _parts(text, c))


def _parts(text: Column, cuts: Column) -> Column:
    """The given parts of a text, in order. To find a place, Spark walks through the text from
    its start, so many parts are taken from pieces of the text."""
    part = lambda t, c, base: F.substring(t, (c["start"] - base + 1).cast("int"), (c["end"] - c["start"]).cast("int"))

    def piece(few: Column) -> Column:
        whole = F.struct(F.element_at(few, 1)["start"].alias("start"), F.element_at(few, -1)["end"].alias("end"))
        body = part(text, whole, F.lit(0).cast("bigint"))
        return _once(F.struct(body.alias("text"), whole["start"].alias("base")), lambda p: F.transform(few, lambda c: part(p["text"], c, p["base"])))

    size = _chunk(cuts)
    starts = F.sequence(F.lit(0), F.size(cuts) - 1, size)
    return F.flatten(F.transform(starts, lambda at: _once(F.slice(cuts, at + 1, size), piece)))


def redacted(text: Column, spans: Column, mark: str = MARK) -> Column:
    """The text with every span replaced by ``mark``."""

    rebuild = lambda merged: F.array_join(_between(text, merged), mark)
    return F.when(F.size(spans) == 0, text).otherwise(_once(_merged(spans), rebuild))


def redact(df: DataFrame, text: str = "text", size: str | None = "n_chars", mark: str = MARK) -> DataFrame:
    """``df`` with every secret in ``text`` replaced; ``size`` names its column of code points, if any."""
    base, every, new = (_spare(df, c) for c in ("base", "every", "redacted"))
    found = with_spans(df, text, base, every)
    found = found.withColumn(new, redacted(F.col(f"`{text}`"), F.col(f"`{every}`"), mark))
    changed = {text: F.col(f"`{new}`")}
    if size in df.columns:
        length = F.char_length(F.col(f"`{new}`")).cast(df.schema[size].dataType)
        changed[size] = F.when(F.size(F.col(f"`{every}`")) > 0, length).otherwise(F.col(f"`{size}`"))
    return found.select(*[changed.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns])
