"""Quality rules as weak supervision: votes, estimated accuracies, posterior quality.

Each rule votes good (1), bad (-1) or abstains (0) on integer features of the
whole text. Votes are counted by pattern, at most 3^rules rows whatever the
corpus size, and expectation-maximisation over the pattern counts estimates for
each rule how often it is right on good and on bad documents, and the share of
good ones. The verdict of a document is its posterior probability of being good,
which replaces the demand that every rule passes.

All of it is DataFrame functions. One pass reads the texts and leaves a narrow
stored table (key, counts, votes); the iterations read only the pattern table;
the driver holds the 2 x rules + 1 estimates. No shuffle but that of patterns,
which are pre-aggregated.

Five-word windows are compared by 64-bit hashes within one text. Defined results:
a null or empty text has no words and fails the base rule; repeated rows give
repeated results; an empty table gives an empty table; other columns pass
through `assess` untouched only where `keep` names them, and not where their name
is that of a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

# Frequent words of the four languages.
STOP_WORDS = ["the", "and", "of", "to", "in", "that", "is", "le", "la", "les", "de", "des", "et", "un", "une", "der", "die", "das", "und", "ist", "von", "zu", "el", "los", "las", "que", "en", "por", "con", "una"]

#: name -> (when it votes bad, when it votes good): integer conditions that Spark and DuckDB read alike.
RULES: dict[str, tuple[str, str]] = {
    "length": ("n_words < 20", "n_words >= 40"),
    "symbols": ("10 * n_symbols > 3 * n_words", "50 * n_symbols <= n_words"),
    "bare_words": ("100 * n_bare > 20 * n_words", "100 * n_bare <= 4 * n_words"),
    "letters": ("100 * n_letters < 75 * word_chars", "100 * n_letters >= 85 * word_chars"),
    "capitals": ("100 * n_caps > 40 * word_chars", "100 * n_caps <= 15 * word_chars"),
    "lines": ("100 * n_dup_lines > 30 * n_lines", "100 * n_dup_lines <= 5 * n_lines"),
    "repeats": ("100 * n_repeat_words > 15 * n_words", "100 * n_repeat_words <= 2 * n_words"),
    "word_size": ("10 * word_chars < 22 * n_words or word_chars > 12 * n_words", "10 * word_chars >= 30 * n_words and word_chars <= 9 * n_words"),
    "stop_words": ("n_words >= 30 and n_stop = 0", "n_stop >= 3"),
    "marks": ("100 * n_marks > 20 * n_words", "100 * n_marks <= 3 * n_words"),
    "digits": ("100 * n_digits > 30 * word_chars", "100 * n_digits <= 10 * word_chars"),
}
BASE_FAILED = "n_words < 10 or 100 * n_repeat_words > 20 * n_words"
ITERATIONS = 12
#: Estimates start here and are drawn to it as by so many more votes: most documents
#: are good, a bad vote is rarely wrong, and a bad document fails some rules, not most.
START, START_GOOD, START_BAD, DRAWN = 0.9, 0.95, 0.35, 10.0
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MADE = (*COUNTS, "n_lines", "n_caps", "n_letters", "n_bare", "n_marks", "n_digits", "n_stop", *(f"vote_{r}" for r in RULES), "base_failed", "quality", "kept")
GAP = "[\\\\x20\\\\x09-\\\\x0D]"


def vote_sql(rule: str) -> str:
    bad, good = RULES[rule]
    return f"case when {bad} then -1 when {good} then 1 else 0 end"


def repeat_words(hashes: str = "hashes", width: int = 5) -> Column:
    """Words in windows whose hash occurs twice or more; a sort only where there are any."""
    pairs = f"array_sort(transform({hashes}, (h, i) -> struct(h, i)))"
    # array(x) and a lambda bind a value to a name, so it is computed once
    twice = f"transform(array({pairs}), s -> filter(s, (e, k) -> coalesce(get(s, k - 1).h = e.h, false) or coalesce(get(s, k + 1).h = e.h, false)))[0]"
    places = f"array_sort(transform({twice}, e -> e.i))"
    covered = f"aggregate({places}, struct(0L as total, 0L as upto), (a, x) -> struct(a.total + least({width}L, x + {width}L - a.upto) as total, x + {width}L as upto)).total"
    return F.expr(f"case when size(array_distinct({hashes})) = size({hashes}) then 0L else {covered} end")


def features(docs: DataFrame, *, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, *keep, counts, votes) of every row."""
    rest = common.passed((key, *keep), *MADE)
    rows = common.spread(docs.select(F.struct(*[F.col(c) for c in rest]).alias("_rest"), F.coalesce(F.col(text), F.lit("")).alias("_text")))
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    parts = rows.select(
        "*",
        F.expr(f"filter(split(_text, '{GAP}+'), w -> w <> '')").alias("words"),
        F.expr("filter(split(_text, '\\n'), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')").alias("lines"),
    )
    windows = parts.select(
        "*",
        F.expr("case when size(words) < 5 then cast(array() as array<bigint>) else transform(sequence(0, size(words) - 5), i -> xxhash64(words[i], words[i + 1], words[i + 2], words[i + 3], words[i + 4])) end").alias("hashes"),
    )
    left = lambda chars: F.expr(f"cast(length(regexp_replace(_text, '[^{chars}]+', '')) as bigint)")
    counts = windows.select(
        *[F.col(f"_rest.{c}").alias(c) for c in rest],
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        left("#*$%&|<>").alias("n_symbols"),
        F.expr("cast(size(lines) - size(array_distinct(lines)) as bigint)").alias("n_dup_lines"),
        repeat_words().alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        left("A-ZÀ-ÖØ-Þ").alias("n_caps"),
        left("0-9A-Za-zÀ-ÖØ-öø-ÿ").alias("n_letters"),
        F.expr("cast(size(split(array_join(words, ' '), '(?:^| )[^0-9A-Za-zÀ-ÖØ-öø-ÿ ]+(?= |$)')) - 1 as bigint)").alias("n_bare"),
        left("!").alias("n_marks"),
        left("0-9").alias("n_digits"),
        F.expr(f"cast(size(array_intersect(words, array({stop}))) as bigint)").alias("n_stop"),
    )
    return counts.select("*", *[F.expr(vote_sql(r)).alias(f"vote_{r}") for r in RULES])


def log_odds(shares: dict[str, tuple[float, float]], good: float) -> str:
    """SQL of the log odds of a good document, from (right on good, right on bad) for each rule.

    Votes are taken as independent given the class, and abstaining as telling nothing.
    """
    parts = [f"ln(cast({good!r} as double) / (1.0 - {good!r}))"]
    for rule, (g, b) in shares.items():
        parts.append(f"case vote_{rule} when 1 then ln(cast({g!r} as double) / (1.0 - {b!r})) when -1 then ln((1.0 - {g!r}) / cast({b!r} as double)) else cast(0 as double) end")
    return " + ".join(parts)


def estimate(votes: DataFrame) -> tuple[dict[str, tuple[float, float]], float]:
    """Expectation-maximisation over counted vote patterns: (right on good, right on bad) by rule, share of good."""
    names = [f"vote_{r}" for r in RULES]
    patterns = common.stored(votes.groupBy(*names).agg(F.count("*").alias("n")).repartition(1), "patterns")
    shares, good = {r: (START_GOOD, START_BAD) for r in RULES}, START
    for _ in range(ITERATIONS):
        odds = patterns.select("*", F.expr(f"1.0 / (1.0 + exp(-({log_odds(shares, good)})))").alias("p"))
        sums = [F.sum(F.expr("n * p")).alias("good"), F.sum("n").alias("all")]
        for r in RULES:
            for name, vote, p in (("g1", 1, "p"), ("g0", -1, "p"), ("b1", -1, "(1.0 - p)"), ("b0", 1, "(1.0 - p)")):
                sums.append(F.sum(F.expr(f"case when vote_{r} = {vote} then n * {p} else cast(0 as double) end")).alias(f"{r}_{name}"))
        row = odds.agg(*sums).first()
        if not row["all"]:
            break
        drawn = lambda yes, no, start: (yes + DRAWN * start) / (yes + no + DRAWN)
        shares = {r: (drawn(row[f"{r}_g1"], row[f"{r}_g0"], START_GOOD), drawn(row[f"{r}_b1"], row[f"{r}_b0"], START_BAD)) for r in RULES}
        good = drawn(row["good"], row["all"] - row["good"], START)
    return shares, good


def assess(docs: DataFrame, *, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), threshold: float = 0.5) -> DataFrame:
    """(key, *keep, counts, votes, base_failed, quality, kept) of every row."""
    table = common.stored(features(docs, key=key, text=text, keep=keep), "votes")
    shares, good = estimate(table)
    quality = F.expr(f"1.0 / (1.0 + exp(-({log_odds(shares, good)})))")
    out = table.select("*", F.expr(BASE_FAILED).alias("base_failed"), quality.alias("quality"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold))


def assess_sql(threshold: float = 0.5) -> str:
    """The same in DuckDB: features, patterns, and one pair of steps an iteration."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    left = lambda chars: f"length(regexp_replace(t, '[^{chars}]+', '', 'g'))"
    odds = " + ".join(["ln(p.good / (1 - p.good))", *(f"case vote_{r} when 1 then ln(p.{r}_g / (1 - p.{r}_b)) when -1 then ln((1 - p.{r}_g) / p.{r}_b) else 0 end" for r in RULES)])
    ctes = [
        "texts as materialized (select row_number() over () as k, doc_id, coalesce(text, '') as t from documents)",
        "split as materialized (select k, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') as w, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) as l from texts)",
        "win as (select k, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] as s from (select k, w, unnest(range(1, len(w) - 3)) as i from split where len(w) >= 5))",
        "twice as (select k, i from (select k, i, count(*) over (partition by k, s) as c from win) where c > 1)",
        "rep as (select k, count(distinct j) as n from (select k, unnest(range(i, i + 5)) as j from twice) group by k)",
        f"feat as materialized (select split.k, doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars, {left('#*$%&|<>')} as n_symbols, len(l) - len(list_distinct(l)) as n_dup_lines, coalesce(rep.n, 0) as n_repeat_words, len(l) as n_lines, {left('A-ZÀ-ÖØ-Þ')} as n_caps, {left('0-9A-Za-zÀ-ÖØ-öø-ÿ')} as n_letters, len(list_filter(w, lambda x: not regexp_matches(x, '[0-9A-Za-zÀ-ÖØ-öø-ÿ]'))) as n_bare, {left('!')} as n_marks, {left('0-9')} as n_digits, len(list_intersect(list_distinct(w), [{stop}])) as n_stop from split left join rep using (k))",
        "votes as materialized (select *, " + ", ".join(f"{vote_sql(r)} as vote_{r}" for r in RULES) + " from feat)",
        "pat as materialized (select " + ", ".join(f"vote_{r}" for r in RULES) + ", count(*)::double as n from votes group by all)",
        f"p0 as (select {START}::double as good, " + ", ".join(f"{START_GOOD}::double as {r}_g, {START_BAD}::double as {r}_b" for r in RULES) + ")",
    ]
    drawn = lambda yes, no, start: f"(coalesce(sum({yes}), 0) + {DRAWN * start}) / (coalesce(sum({yes}), 0) + coalesce(sum({no}), 0) + {DRAWN})"
    for k in range(ITERATIONS):
        ctes.append(f"e{k} as materialized (select pat.*, 1 / (1 + exp(-({odds}))) as q from pat, p{k} p)")
        ctes.append(
            f"p{k + 1} as materialized (select {drawn('n * q', 'n * (1 - q)', START)} as good, "
            + ", ".join(f"{drawn(f'case when vote_{r} = 1 then n * q else 0 end', f'case when vote_{r} = -1 then n * q else 0 end', START_GOOD)} as {r}_g, {drawn(f'case when vote_{r} = -1 then n * (1 - q) else 0 end', f'case when vote_{r} = 1 then n * (1 - q) else 0 end', START_BAD)} as {r}_b" for r in RULES)
            + f" from e{k})"
        )
    base = f"({BASE_FAILED})"
    return (
        "with " + ", ".join(ctes) + f" select doc_id, n_words, word_chars, n_symbols::bigint as n_symbols, n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, {base} as base_failed, "
        f"not {base} and 1 / (1 + exp(-({odds}))) >= {threshold} as kept from votes, p{ITERATIONS} p"
    )
