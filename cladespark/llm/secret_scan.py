"""Secret scan: base patterns, and a battery of randomness tests with false-discovery control.

Base spans are the matches of three fixed patterns.  The battery adds spans: for every long run
of key-like characters the encoding is inferred (hex, base 32, base 36, base 64), and two hypotheses are tested.

* That its symbols are drawn at random: chi-squared uniformity over the encoding's alphabet, Wald-Wolfowitz
  runs above and below the alphabet's middle, and lag-1 serial correlation, joined by Fisher's method.
  Benjamini-Hochberg control at ``RATE`` throws out runs that are not random.
* That it is a natural name (words, camel case, paths, dates): changes between upper case, lower case, digits and
  symbols are then rare (at most ``CHANGES`` of all places) and vowels frequent (``VOWELS`` of the letters).  Both
  counts, joined by Stouffer's method, give a p-value; Benjamini-Hochberg control at ``RATE`` over what
  is left decides what is found, so of the spans added at most that share is expected to be natural.

Both are controlled by classes of length: short runs give the tests less power, so they are judged among
themselves, and a class without power finds nothing.  What is found is added as ``random`` spans.

All of it is built-in column functions: no Python, pandas, Arrow or RDD code runs.  The
p-values are counted in buckets of a fixed number, so the control ranks all runs of the corpus
without sorting them, and the thresholds are two numbers for each of the few length classes.
Positions are summed in blocks of ``BLOCK`` matches, so a text's work is near linear in its matches.

Defined results: a null text counts as empty (no spans; the digest is that of an empty string);
repeated rows give equal rows; an empty table gives an empty table; ``redact`` keeps other columns, of any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import dropped, stored

#: Fixed: the base patterns, in the order in which kinds are listed.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # AKIA[A-Z0-9]+ of 20 characters: runs are maximal, so failing ones just don't match
HEX = r"[0-9a-f]{24,}"  # likewise
LEAST_VALUE = 6
KINDS = ("assign", "access", "hex", "random")

#: What stands for a secret in a masked text.
MARK = "[SECRET]"

#: Runs that the battery looks at.
RUN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
#: Share of random runs expected among those thrown out, and of natural names among those found.
RATE = 0.01
#: Changes of character class per place by symbols of the encoding, and vowels per letter, that a natural name may show.
CHANGES, VOWELS = {16: 0.2, 32: 0.15, 36: 0.15, 64: 0.35}, 0.33
#: Buckets of -log10(p), this many for a power of ten, up to the last.
PER_DECADE, LAST_BUCKET = 20, 1200
#: Lengths from which a new class begins.
LENGTH_CLASSES = (20, 24, 32, 48, 64, 128, 512)

#: Matches whose positions are summed together.
BLOCK = 256

_BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def spans(text: Column, pattern: str) -> tuple[Column, Column]:
    """Matches of a pattern and the texts between them; positions follow from their lengths."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)


def _let(name: str, value: str, body: str) -> str:
    """SQL of ``body`` with ``name`` for ``value``, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _blocks(array: str) -> str:
    """SQL of an array that isn't empty, cut into blocks."""
    return f"transform(sequence(0, (size({array}) - 1) div {BLOCK}), i -> slice({array}, i * {BLOCK} + 1, {BLOCK}))"


def _running(blocks: str, first: str, over_block: str, over_row: str, row: str, kind: str) -> str:
    """SQL of an array of ``row`` (by ``x`` and the running value ``a.at`` before it), flat.

    ``over_block`` is the value ``a.at`` after a block ``s``, ``over_row`` after a row ``x``; arrays grow within blocks alone.
    """
    starts = f"aggregate({blocks}, named_struct('at', {first}, 'out', cast(array() as array<int>)), (a, s) -> named_struct('at', {over_block}, 'out', array_append(a.out, a.at)), a -> a.out)"
    inner = f"aggregate(s, named_struct('at', f, 'out', cast(array() as array<{kind}>)), (a, x) -> named_struct('at', {over_row}, 'out', array_append(a.out, {row})), a -> a.out)"
    return f"flatten(zip_with({blocks}, {starts}, (s, f) -> {inner}))"


def _placed(matches: str, gaps: str) -> Column:
    """array<struct<s, e>> of the code point positions of matches."""
    steps = f"transform({matches}, (x, i) -> named_struct('g', length({gaps}[i]), 'l', length(x)))"
    sums = _running("bl", "0", "a.at + aggregate(s, 0, (t, x) -> t + x.g + x.l)", "a.at + x.g + x.l", "named_struct('s', a.at + x.g, 'e', a.at + x.g + x.l)", "struct<s:int,e:int>")
    return F.expr(f"if(size({matches}) = 0, cast(array() as array<struct<s:int,e:int>>), {_let('st', steps, _let('bl', _blocks('st'), sums))})")


def _upper_tail(z: str) -> str:
    """P(Z > z) of the standard normal law (Abramowitz and Stegun 26.2.17), at least 1e-60."""
    t = f"(1 / (1 + 0.2316419D * abs({z})))"
    poly = f"({t} * (0.319381530D + {t} * (-0.356563782D + {t} * (1.781477937D + {t} * (-1.821255978D + {t} * 1.330274429D)))))"
    tail = f"(exp(-0.5D * {z} * {z}) * 0.3989422804014327D * {poly})"
    return f"greatest(1e-60D, if({z} >= 0, {tail}, 1 - {tail}))"


def _rate_of(k: str) -> str:
    return f"case {k} " + " ".join(f"when {n} then {rate}D" for n, rate in CHANGES.items()) + " end"


def _tested(runs: str) -> Column:
    """For each run: length class and buckets of its p-values as a random and as a natural one, or nulls where no encoding is inferred.

    One transform after another, each with the values that the next needs.
    """
    encoding = f"""transform({runs}, r -> named_struct('s', rtrim('=', r), 'k', case
        when rtrim('=', r) rlike '^([0-9a-f]+|[0-9A-F]+)$' and r rlike '[0-9]' and r rlike '[A-Fa-f]' then 16
        when rtrim('=', r) rlike '^[A-Z2-7]+$' and r rlike '[0-9]' and r rlike '[A-Z]' then 32
        when rtrim('=', r) rlike '^[a-z0-9]+$' and r rlike '[0-9]' and r rlike '[a-z]' then 36
        when r rlike '[0-9]' and r rlike '[a-z]' and r rlike '[A-Z]' then 64
        else 0 end))"""
    alphabet = f"""case x.k when 16 then '0123456789abcdef' when 32 then 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567' when 36 then 'abcdefghijklmnopqrstuvwxyz0123456789' else '{_BASE64}' end"""
    own = "case x.k when 16 then lower(x.s) when 64 then translate(x.s, '-_', '+/') else x.s end"
    kinds = "translate(x.s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_', '" + "U" * 26 + "l" * 26 + "d" * 10 + "s" * 4 + "')"
    counts = f"""named_struct('changes', length(regexp_replace({kinds}, '(.)\\\\1+', '$1')) - 1D, 'letters', cast(length(translate(x.s, '0123456789+/-_', '')) as double),
        'vowels', cast(length(x.s) - length(translate(x.s, 'aeiouAEIOU', '')) as double))"""
    coded = f"transform({encoding}, x -> named_struct('k', x.k, 's', {own}, 'a', split({alphabet}, ''), 'w', {alphabet}, 'q', {_rate_of('x.k')}, 'm', length(x.s) - 1, 'o', if(x.k = 0, null, {counts})))"
    natural = f"""if(x.k = 0, 0D, (x.o.changes - x.m * x.q) / sqrt(x.m * x.q * (1 - x.q))
        * if(x.k = 16 or x.o.letters = 0, 1D, sqrt(0.5D)) + if(x.k = 16 or x.o.letters = 0, 0D, sqrt(0.5D) * ({VOWELS}D * x.o.letters - x.o.vowels) / sqrt(x.o.letters * {VOWELS * (1 - VOWELS)}D)))"""
    codes = f"""transform({coded}, x -> named_struct('k', x.k, 'n', length(x.s), 'z', {natural},
        'squares', if(x.k = 0, 0L, aggregate(x.a, 0L, (acc, c) -> acc + cast(length(x.s) - length(replace(x.s, c, '')) as bigint) * (length(x.s) - length(replace(x.s, c, ''))))),
        'c', if(x.k = 0, cast(array() as array<int>), transform(filter(split(x.s, ''), c -> c != ''), c -> locate(c, x.w) - 1))))"""
    moments = f"""transform({codes}, x -> named_struct('k', x.k, 'n', x.n, 'z', x.z, 'squares', x.squares, 'sums',
        aggregate(x.c, named_struct('i', 0, 'prev', 0, 'high', 0L, 'runs', 0L, 'sx', 0D, 'sxx', 0D, 'sxy', 0D, 'first', 0D),
          (a, v) -> named_struct(
            'i', a.i + 1, 'prev', v,
            'high', a.high + if(2 * v >= x.k, 1L, 0L),
            'runs', a.runs + if(a.i = 0 or (2 * v >= x.k) != (2 * a.prev >= x.k), 1L, 0L),
            'sx', a.sx + v, 'sxx', a.sxx + cast(v as double) * v,
            'sxy', a.sxy + if(a.i = 0, 0D, cast(v as double) * a.prev),
            'first', if(a.i = 0, cast(v as double), a.first)))))"""
    # Wilson-Hilferty for chi-squared; both tails for runs and correlation.
    scores = f"""transform({moments}, x -> named_struct('k', x.k, 'n', x.n, 'z', x.z,
        'chi', if(x.k = 0, 0D, (power((cast(x.k as double) / x.n * x.squares - x.n) / (x.k - 1), 1D / 3) - (1 - 2D / (9 * (x.k - 1)))) / sqrt(2D / (9 * (x.k - 1)))),
        'runs', if(x.k = 0 or x.sums.high = 0 or x.sums.high = x.n, if(x.k = 0, 0D, -sqrt(cast(x.n as double))),
          (x.sums.runs - (2D * x.sums.high * (x.n - x.sums.high) / x.n + 1))
            / sqrt(greatest(1e-9D, (2D * x.sums.high * (x.n - x.sums.high) / x.n) * (2D * x.sums.high * (x.n - x.sums.high) / x.n - 1) / (x.n - 1)))),
        'serial', if(x.k = 0 or x.sums.sxx * x.n <= x.sums.sx * x.sums.sx, 0D,
          ((x.sums.sxy - x.sums.sx / x.n * (2 * x.sums.sx - x.sums.first - x.sums.prev) + (x.n - 1) * (x.sums.sx / x.n) * (x.sums.sx / x.n))
            / (x.sums.sxx - x.sums.sx * x.sums.sx / x.n) + 1D / (x.n - 1)) * sqrt(cast(x.n as double)))))"""
    logs = f"""transform({scores}, x -> named_struct('k', x.k, 'n', x.n, 'z', x.z, 'h',
        -(ln({_upper_tail('x.chi')}) + ln(least(1D, 2 * {_upper_tail('abs(x.runs)')})) + ln(least(1D, 2 * {_upper_tail('abs(x.serial)')})))))"""
    bucket = f"least({LAST_BUCKET}, cast(floor({PER_DECADE} * greatest(0D, x.h - ln(1 + x.h + x.h * x.h / 2)) / ln(10D)) as int))"
    length_class = "case " + " ".join(f"when x.n >= {n} then {k}" for k, n in reversed(list(enumerate(LENGTH_CLASSES)))) + " else 0 end"
    unnatural = f"least({LAST_BUCKET}, cast(floor({PER_DECADE} * -log10({_upper_tail('x.z')})) as int))"
    return F.expr(f"transform({logs}, x -> named_struct('class', if(x.k = 0, null, {length_class}), 'bucket', if(x.k = 0, null, {bucket}), 'unnatural', if(x.k = 0, null, {unnatural})))")


def annotated(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """(row, base, runs): the row of ``docs`` as a struct, array<struct<s, kind, e>>, array<struct<s, e, class, bucket, unnatural>>."""
    out = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text_column), F.lit("")).alias("own"))
    for name, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("run", RUN)):
        matches, gaps = spans(F.col("own"), pattern)
        out = out.withColumns({name: matches, f"{name}_gaps": gaps})
    out = out.withColumn("lengths", F.transform(F.regexp_extract_all("own", F.lit(ASSIGN), F.lit(2)), F.length))
    out = out.withColumns({f"{name}_at": _placed(name, f"{name}_gaps") for name in ("assign", "access", "hex", "run")} | {"tests": _tested("run")})
    base = F.expr(f"""array_sort(concat(
        transform(filter(arrays_zip(assign_at, lengths), x -> x.lengths >= {LEAST_VALUE}), x -> named_struct('s', x.assign_at.s, 'kind', 0, 'e', x.assign_at.e)),
        transform(access_at, x -> named_struct('s', x.s, 'kind', 1, 'e', x.e)),
        transform(hex_at, x -> named_struct('s', x.s, 'kind', 2, 'e', x.e))))""")
    runs = F.expr("""filter(transform(arrays_zip(run_at, tests), x -> named_struct('s', x.run_at.s, 'e', x.run_at.e, 'class', x.tests.class, 'bucket', x.tests.bucket, 'unnatural', x.tests.unnatural)), x -> x.class is not null)""")
    return out.select("row", base.alias("base"), runs.alias("runs"))


def _passing(counts: DataFrame, bucket: str, of_all: DataFrame) -> dict[int, int]:
    """For each class the least bucket whose p-value Benjamini-Hochberg control lets pass; ``of_all`` has the numbers of tests."""
    ranked = counts.groupBy("class", bucket).agg(F.sum("n").alias("n")).selectExpr("class", bucket, f"sum(n) over (partition by class order by {bucket} desc) as rank")
    # the largest p-value in a bucket stands for all in it, so the control is on the safe side
    passing = ranked.join(of_all, "class").where(F.expr(f"power(10D, -{bucket} / {PER_DECADE}D) <= {RATE}D * rank / m"))
    return {r["class"]: r["least"] for r in passing.groupBy("class").agg(F.min(bucket).alias("least")).collect()}


def thresholds(found: DataFrame) -> tuple[dict[int, int], dict[int, int]]:
    """For each length class the bucket from which runs are held not to be random, and that from which they are held not to be natural.

    Counts run over all runs and have a fixed number of buckets; at most one row a class comes to the driver. A class
    without a second bucket finds nothing.
    """
    counts = stored(found.select(F.explode("runs").alias("r")).groupBy("r.class", "r.bucket", "r.unnatural").agg(F.count("*").alias("n")), "secret-counts")
    of_all = counts.groupBy("class").agg(F.sum("n").alias("m"))
    ordered = _passing(counts, "bucket", of_all)
    out = ordered, _passing(counts.where(_random("", ordered)), "unnatural", of_all)
    dropped(counts)
    return out


def _random(x: str, ordered: dict[int, int]) -> str:
    return " and ".join(["true", *(f"not ({x}class = {c} and {x}bucket >= {b})" for c, b in sorted(ordered.items()))])


def with_spans(found: DataFrame, limits: tuple[dict[int, int], dict[int, int]]) -> DataFrame:
    """Turns runs into the spans that are added: ``spans`` is every span, by start and kind."""
    ordered, unnatural = limits
    named = " or ".join(["false", *(f"(x.class = {c} and x.unnatural >= {b})" for c, b in sorted(unnatural.items()))])
    added = F.expr(f"transform(filter(runs, x -> {_random('x.', ordered)} and ({named})), x -> named_struct('s', x.s, 'kind', 3, 'e', x.e))")
    return found.withColumn("spans", F.array_sort(F.concat("base", added))).drop("runs")


def joined(column: str) -> Column:
    names = ", ".join(f"'{k}'" for k in KINDS)
    return F.expr(f"array_join(transform({column}, x -> concat(array({names})[x.kind], ':', x.s, ':', x.e)), ',')")


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, base spans, all spans) of whole texts as arrays of structs (s, kind, e).

    The spans and test results, without the texts, are stored once: the thresholds need all of them.
    """
    found = annotated(docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")))
    found = stored(found.select(F.col("row.doc_id").alias("doc_id"), "base", "runs"), "secret-runs")
    return with_spans(found, thresholds(found))


def report(spans_: DataFrame) -> DataFrame:
    """Counts by kind, a digest of the base spans, and all spans as text."""
    count = lambda kind: F.expr(f"cast(size(filter(base, x -> x.kind = {kind})) as bigint)")
    return spans_.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def redact(docs: DataFrame, mark: str = MARK, text_column: str = "text") -> DataFrame:
    """Replaces every span by a mark; spans that overlap or touch are replaced by one. Columns and clean texts stay as they are.

    Rows with their spans are stored once, so the battery runs once over each text.
    """
    found = stored(annotated(docs, text_column), "secret-rows")
    spanned = with_spans(found, thresholds(found)).select("row", "spans", F.col(f"row.`{text_column}`").alias("own"))
    ends = _running("bl", "-1", "greatest(a.at, array_max(transform(s, x -> x.e)))", "greatest(a.at, x.e)", "named_struct('s', x.s, 'before', a.at)", "struct<s:int,before:int>")
    # a span that begins after all ends before it begins a marked place; those ends are the end of the place before
    places = _let("bl", _blocks("spans"), f"filter({ends}, x -> x.s > x.before)")
    literal = mark.replace("\\", "\\\\").replace("'", "\\'")
    block = _let("part", "substring(own, greatest(0, b[0].before) + 1, b[size(b) - 1].s - greatest(0, b[0].before))",
                 f"array_join(transform(b, x -> concat(substring(part, greatest(0, x.before) - greatest(0, b[0].before) + 1, x.s - greatest(0, x.before)), '{literal}')), '')")
    masked = _let("places", places, f"array_join(transform({_blocks('places')}, b -> {block}), '')")
    text = F.expr(f"if(size(spans) = 0, own, concat({masked}, substring(own, array_max(transform(spans, x -> x.e)) + 1)))")
    return spanned.select(*[text.alias(c) if c == text_column else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
