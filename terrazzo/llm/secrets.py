"""Secret scans by rules, narrowed by an inverted index of trigrams.

From each rule's pattern a Boolean trigram query is derived at planning time.
The texts' trigrams that any query names form the index: postings of (trigram,
document). Postings are intersected per rule by counting what its query asks
for, which leaves candidate rules per document; only these are run on its text.
Rules without mandatory trigrams are run on every text.

All on DataFrame functions. The index holds only the trigrams of the rules (a few
dozen), so it grows with the number of documents, not with their length; postings
are dealt by document and summed before they are dealt, and texts move once, by
document, to meet their candidates. Documents are told apart by id and text hash:
repeated rows share postings and each keep their result.

Positions come from splitting a text at the matches: the lengths of what lies
between and of the matches add up. Defined results: a null text counts as empty;
an empty table gives an empty table; columns named in `keep` pass through, but
one named `spans`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, trigrams

# The kinds that the contract names, in its order, with the least
# length of the part that is measured (group number, code points).
BASE: dict[str, tuple[str, int, int]] = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]+", 0, 24),
}
#: Further kinds, by the shapes that issuers publish.
MORE: dict[str, tuple[str, int, int]] = {
    "pem": (r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    "code_host": (r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    "chat": (r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    "cloud_api": (r"AIza[0-9A-Za-z_-]{35}", 0, 0),
    "payment": (r"[rs]k_live_[0-9A-Za-z]{16,}", 0, 0),
    "web_token": (r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
    "bearer": (r"(?i)authorization:\x20*bearer\x20+([A-Za-z0-9._~+/-]{16,})", 0, 0),
    "login_url": (r"[a-z][a-z0-9+.-]*://[^\x20\x09-\x0D/:@]+:[^\x20\x09-\x0D/@]+@", 0, 0),
}
RULES = BASE | MORE
#: Patterns with the same spans that reject short runs at once: a greedy run is as long as it can be.
FASTER = {"hex": r"[0-9a-f]{24,}"}
#: Matches whose positions are summed in one go; keeps the sum of a long list from being copied whole each time.
BLOCK = 256


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def queries(rules: dict[str, tuple[str, int, int]]) -> dict[str, list[trigrams.Clause]]:
    return {kind: trigrams.query(pattern) for kind, (pattern, _, _) in rules.items()}


def postings(rows: DataFrame, wanted: list[str]) -> DataFrame:
    """(key, digest, gram): the wanted trigrams that each text holds."""
    vocabulary = ", ".join(map(quoted, wanted))
    folded = rows.select("key", "digest", F.lower("_text").alias("low"))
    return folded.select("key", "digest", F.explode(F.expr(f"filter(array({vocabulary}), g -> contains(low, g))")).alias("gram"))


def candidates(rows: DataFrame, rules: dict[str, tuple[str, int, int]]) -> DataFrame:
    """(key, digest, found): the rules whose trigram query a document meets."""
    spark: SparkSession = rows.sparkSession
    asked = []
    sizes = {}
    for kind, clauses in queries(rules).items():
        sizes[kind] = len(clauses)
        for c, alternatives in enumerate(clauses):
            for a, wanted in enumerate(alternatives):
                asked += [(g, kind, c, a, len(wanted)) for g in sorted(wanted)]
    # As many rows as the rules have trigrams.
    terms = spark.createDataFrame(asked, "gram string, kind string, clause int, alternative int, need int")
    needs = F.create_map(*[F.lit(x) for kind, n in sizes.items() if n for x in (kind, n)])
    lists = postings(rows, sorted({x[0] for x in asked}))
    met = lists.join(F.broadcast(terms), "gram").groupBy("key", "digest", "kind", "clause", "alternative", "need").agg(F.count_distinct("gram").alias("held"))
    whole = met.filter("held = need").groupBy("key", "digest", "kind").agg(F.count_distinct("clause").alias("clauses"))
    return whole.filter(F.col("clauses") == needs[F.col("kind")]).groupBy("key", "digest").agg(F.collect_set("kind").alias("found"))


def match_spans(kind: str, rule: tuple[str, int, int]) -> str:
    """SQL for array<struct<start, rank, kind, stop>> of a rule's matches in `_text`."""
    pattern, group, least = rule
    rank = list(RULES).index(kind)
    rx = quoted(FASTER[kind] if rule == RULES.get(kind) and kind in FASTER else pattern)
    empty = "cast(array() as array<struct<start:int,stop:int>>)"
    # (gap before it, its length) of every match
    steps = f"transform(array(split(_text, {rx}, -1)), p -> transform(regexp_extract_all(_text, {rx}, 0), (m, i) -> struct(length(p[i]) as gap, length(m) as size)))[0]"
    inner = f"aggregate(b, struct(acc.at as at, {empty} as spans), (x, s) -> struct(x.at + s.gap + s.size as at, array_append(x.spans, struct(x.at + s.gap as start, x.at + s.gap + s.size as stop)) as spans))"
    sums = (
        f"transform(array({steps}), t -> case when size(t) = 0 then {empty} else aggregate(transform(sequence(0, (size(t) - 1) div {BLOCK}), k -> slice(t, k * {BLOCK} + 1, {BLOCK})),"
        f" struct(0 as at, cast(array() as array<array<struct<start:int,stop:int>>>) as all), (acc, b) -> transform(array({inner}), y -> struct(y.at as at, array_append(acc.all, y.spans) as all))[0], acc -> flatten(acc.all)) end)[0]"
    )
    measured = "substring(_text, s.start + 1, s.stop - s.start)"
    size = f"length(regexp_extract({measured}, {rx}, {group}))" if group else "s.stop - s.start"
    return f"transform(filter({sums}, s -> {size} >= {least}), s -> struct(s.start as start, {rank} as rank, '{kind}' as kind, s.stop as stop))"


def scan(docs: DataFrame, rules: dict[str, tuple[str, int, int]] = RULES, *, key: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, *keep, spans) of every row; spans: array<struct<start, rank, kind, stop>> in order, code points, end exclusive."""
    body = F.coalesce(F.col(text), F.lit(""))
    keep = tuple(common.passed(keep, key, "spans"))
    docs = common.spread(docs.select(*dict.fromkeys([key, text, *keep])))
    rows = docs.select(F.col(key).alias("key"), F.xxhash64(body).alias("digest"), body.alias("_text"), F.struct(*[F.col(c) for c in keep] or [F.lit(1)]).alias("_rest"))
    full = {k for k, q in queries(rules).items() if not q}
    narrowed = candidates(rows, {k: r for k, r in rules.items() if k not in full})
    met = rows.alias("r").join(narrowed.alias("c"), F.expr("r.key <=> c.key and r.digest = c.digest"), "left").select("r.*", "c.found")
    none = "cast(array() as array<struct<start:int,rank:int,kind:string,stop:int>>)"
    parts = [match_spans(k, r) if k in full else f"case when array_contains(found, '{k}') then {match_spans(k, r)} else {none} end" for k, r in rules.items()]
    out = met.withColumn("spans", F.expr(f"array_sort(concat({', '.join(parts)}))"))
    return out.select(F.col("key").alias(key), *[F.col(f"_rest.{c}").alias(c) for c in keep], "spans")


def digest_columns(found: DataFrame) -> DataFrame:
    """The counts and digests of the base kinds, and all spans as one string."""
    line = lambda spans: f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.stop)), ',')"
    base = f"filter(spans, s -> s.rank < {len(BASE)})"
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.expr(f"sha2({line(base)}, 256)").alias("base_sha256"), F.expr(line("spans")).alias("spans"))


def redacted(text: str = "text", mark: str = "[secret]") -> str:
    """SQL that puts `mark` for each run of overlapping spans in a text."""
    # A span that begins before an earlier one ends is part of the same run.
    runs = "aggregate(spans, struct(0 as at, '' as done), (a, s) -> struct(greatest(a.at, s.stop) as at, case when s.start < a.at then a.done else concat(a.done, substring({t}, a.at + 1, s.start - a.at), '{m}') end as done), a -> concat(a.done, substring({t}, a.at + 1)))"
    return runs.format(t=text, m=mark)


def scan_sql() -> str:
    """The query's rows in DuckDB."""
    order = list(RULES)
    parts = []
    for kind, (pattern, group, least) in RULES.items():
        rx = "'" + pattern.replace("'", "''") + "'"
        size = f"length(regexp_extract(m, {rx}, {group}))" if group else "length(m)"
        parts.append(
            f"select k, {order.index(kind)} as rank, '{kind}' as kind, stop - length(m) as start, stop, {size} as size, {least} as least from "
            f"(select k, m, sum(length(m) + length(p)) over (partition by k order by i) as stop from (select k, unnest(regexp_extract_all(t, {rx})) as m, unnest(string_split_regex(t, {rx})[:-2]) as p, unnest(range(len(regexp_extract_all(t, {rx})))) as i from texts where regexp_matches(t, {rx})))"
        )
    line = "kind || ':' || start || ':' || stop"
    return (
        "with texts as (select row_number() over () as k, doc_id, coalesce(text, '') as t from documents), spans as (select k, rank, kind, start::bigint as start, stop::bigint as stop from (" + " union all ".join(parts) + ") where size >= least), "
        f"lines as (select k, {', '.join(f'count(*) filter (rank = {i}) as n_{b}' for i, b in enumerate(BASE))}, string_agg({line}, ',' order by start, rank, stop) filter (rank < {len(BASE)}) as base, string_agg({line}, ',' order by start, rank, stop) as spans from spans group by k) "
        f"select doc_id, {', '.join(f'coalesce(n_{b}, 0) as n_{b}' for b in BASE)}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from texts left join lines using (k)"
    )
