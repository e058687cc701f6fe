"""Operator 12: secret scans with multipart credential linking, in DataFrame functions only.

Base spans stand by themselves: ``assign`` (a key word and its value), ``access`` (AKIA...)
and ``hex``. Weak candidates don't: a secret part (a short or oddly named value, or a run
of mixed letters and digits), an identifier (a user, client or account) and an endpoint (a
URL, or a named host) are in many clean texts. A credential has several parts, so a weak
candidate is reported when its complement lies in its scope:

* a secret part where an identifier (access or weak) or an endpoint is;
* an identifier where a secret (assign, hex or weak) is;
* an endpoint where both an identifier and a secret are.

The scope of a candidate is the interval ``REACH`` code points to each side of it, cut at
blank lines. Candidates and complements are joined by interval: the spans of a kind don't
overlap, so they are sorted by start and end alike, and the first complement that ends
after the scope's start is found by binary search; it must start before the scope's end.
All spans of a text are in its row, so the join moves no row, no key can be hot, and a
text with n candidates costs n log n, not n^2. Weak candidates that overlap a base span
are that span. Positions come from the texts between the matches, summed in blocks, so
they count code points and the cost is near linear in the matches.

Cases: a null or empty text has no spans; texts are read whole, however long; repeated
rows are judged alike, each on its own; spans that start together are in the order of the
kinds; an empty table gives no rows; columns not named in ``keep`` are ignored, and
``keep`` can't name ``secrets`` or ``linked`` (an error)."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.llm.quality import let

#: Code points to each side of a weak candidate in which its complement must lie.
REACH = 200
#: Kinds in the order in which spans of one start are listed.
BASE_KINDS = ("assign", "access", "hex")
WEAK_KINDS = ("secret", "identifier", "endpoint")
#: Matches whose lengths are summed one by one before their block's sum is used.
SUM_BLOCK = 256


def _either_case(words: str) -> str:
    """The pattern of words (letters, ``_?`` and ``|``) with ASCII letters in either case."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


_SET = r"""["']?\x20*[:=]\x20*["']?"""
_VALUE = "[A-Za-z0-9+/_.=-]+"
#: Patterns of the base kinds. Where a match fails its length (hex, access) no part of it can
#: pass, so the length stands in the pattern; an assignment's value is checked afterwards.
ASSIGN = f"(?:{_either_case('password|passwd|secret|token|api_?key')}){_SET}{_VALUE}"
ASSIGN_VALUE = f"^(?:{_either_case('password|passwd|secret|token|api_?key')}){_SET}({_VALUE})$"
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
LEAST_VALUE = 6
#: Patterns of the weak kinds.
WEAK_SECRET = (f"(?:{_either_case('password|passwd|passphrase|pass|pwd|secret|secret_?key|private_?key|access_?token|token|api_?key|credential|auth')})"
               f"{_SET}[A-Za-z0-9+/_.=!@$%^&*-]{{3,}}|[A-Za-z0-9+/]{{20,}}")
IDENTIFIER = (f"(?:{_either_case('access_?key|access_?key_?id|account|account_?id|client_?id|app_?id|user|user_?name|login')})"
              f"{_SET}[A-Za-z0-9+/_.@-]{{3,}}|A[KS]IA[A-Z0-9]{{8,}}")
ENDPOINT = (r"[A-Za-z]{2,15}://[A-Za-z0-9][A-Za-z0-9_.:@/?&=%~+-]*|"
            f"(?:{_either_case('host|host_?name|endpoint|server|database|bucket|region')}){_SET}[A-Za-z0-9_.:/-]{{3,}}")
BLANK_LINE = r"\n[\x20\x09\x0B-\x0D]*\n"


def _sums_before(lengths: Column) -> Column:
    """The sum of all elements before each element. Sums inside a block of elements are
    made one by one, sums of whole blocks once, so nothing grows with the square."""
    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0), lambda a, v: a + v)

    def blocks(n: Column) -> Column:
        sums = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / SUM_BLOCK).cast("int")),
                           lambda b: total(F.slice(lengths, b * SUM_BLOCK + 1, SUM_BLOCK)))
        return F.aggregate(sums, F.array(F.lit(0)), lambda a, s: F.array_append(a, F.element_at(a, -1) + s))

    return let(blocks(F.size(lengths)), lambda before: F.transform(lengths, lambda _, i: (
        F.get(before, F.floor(i / SUM_BLOCK).cast("int"))
        + total(F.slice(lengths, (F.floor(i / SUM_BLOCK) * SUM_BLOCK + 1).cast("int"), i % SUM_BLOCK)))))


_NONE = "array<struct<start:int,end:int,text:string>>"


def matches(text: Column, pattern: str) -> Column:
    """Leftmost matches that don't overlap: array of (start, end, text), code points, end
    exclusive. Most texts have none and are searched once."""
    def placed(hits: Column) -> Column:
        def ends(gaps: Column) -> Column:
            steps = F.transform(hits, lambda h, i: F.length(F.get(gaps, i)) + F.length(h))
            return let(let(steps, _sums_before), lambda before: F.transform(hits, lambda h, i: let(
                F.get(before, i) + F.length(F.get(gaps, i)),
                lambda s: F.struct(s.alias("start"), (s + F.length(h)).alias("end"), h.alias("text")))))
        return F.when(F.size(hits) > 0, let(F.split(text, pattern, -1), ends)).otherwise(F.array().cast(_NONE))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def _first_after(spans: Column, at: Column) -> Column:
    """How many of the sorted spans end at or before ``at``, by halving steps."""
    steps = F.array(*[F.lit(1 << i) for i in range(30, -1, -1)])
    return F.aggregate(steps, F.lit(0), lambda p, s: F.when(F.get(spans, p + s - 1)["end"] <= at, p + s).otherwise(p))


def meets(spans: Column, low: Column, high: Column) -> Column:
    """Whether one of the sorted spans overlaps [low, high)."""
    return F.when(F.size(spans) == 0, F.lit(False)).otherwise(let(
        _first_after(spans, low), lambda i: F.coalesce(F.get(spans, i)["start"] < high, F.lit(False))))


def _scope(breaks: Column, p: Column) -> Column:
    """[low, high) of the scope of a span: REACH to each side, cut at the blank lines."""
    def cut(i: Column) -> Column:
        before, after = F.get(breaks, i - 1)["end"], F.get(breaks, i)["start"]
        return F.struct(F.greatest(p["start"] - REACH, F.coalesce(before, F.lit(0))).alias("low"),
                        F.least(p["end"] + REACH, F.coalesce(after, F.lit(2**31 - 1))).alias("high"))
    return let(_first_after(breaks, p["start"]), cut)


def _any(parts: list[Callable[[], Column]]) -> Column:
    out = parts[0]()
    for p in parts[1:]:
        out = out | p()
    return out


def linked(text: Column, base: Column) -> Column:
    """The weak candidates with a complement in scope: array of (start, end, kind). ``base`` is
    a struct of the base spans by kind."""
    def weak(pattern: str, keep: Callable[[Column], Column] | None = None) -> Column:
        found = matches(text, pattern)
        return F.filter(found, lambda p: (F.lit(True) if keep is None else keep(p["text"])) & ~_any(
            [lambda k=k: meets(base[k], p["start"], p["end"]) for k in BASE_KINDS]))

    def mixed(s: Column) -> Column:
        return s.rlike("[:=]") | (s.rlike("[a-z]") & s.rlike("[A-Z]") & s.rlike("[0-9]"))

    none = F.array().cast("array<struct<start:int,end:int,kind:string>>")

    def joined(w: Column) -> Column:
        ids, keys = [base["access"], w["identifier"]], [base["assign"], base["hex"], w["secret"]]

        def pick(kind: str, test: Callable[[Column], Column]) -> Column:
            hit = F.filter(w[kind], lambda p: let(_scope(w["breaks"], p), test))
            return F.transform(hit, lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"),
                                                       F.lit(kind).alias("kind")))

        def one_of(spans: list[Column], s: Column) -> Column:
            return _any([lambda x=x: meets(x, s["low"], s["high"]) for x in spans])

        return F.concat(pick("secret", lambda s: one_of([*ids, w["endpoint"]], s)),
                        pick("identifier", lambda s: one_of(keys, s)),
                        pick("endpoint", lambda s: one_of(ids, s) & one_of(keys, s)))

    def parts(secret: Column) -> Column:
        # without any secret in the text nothing can be linked
        some = (F.size(secret) > 0) | (F.size(base["assign"]) > 0) | (F.size(base["hex"]) > 0)
        return F.when(some, let(F.struct(
            secret.alias("secret"), weak(IDENTIFIER).alias("identifier"), weak(ENDPOINT).alias("endpoint"),
            matches(text, BLANK_LINE).alias("breaks")), joined)).otherwise(none)

    return let(weak(WEAK_SECRET, mixed), parts)


def base_spans(text: Column) -> Column:
    """Struct of the base spans by kind: assign, access, hex."""
    assign = F.filter(matches(text, ASSIGN), lambda m: F.length(
        F.regexp_extract(m["text"], ASSIGN_VALUE, 1)) >= LEAST_VALUE)
    return F.struct(assign.alias("assign"), matches(text, ACCESS).alias("access"), matches(text, HEX).alias("hex"))


def find_secrets(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns of ``keep`` with ``secrets`` (base spans by kind: start, end, text) and
    ``linked`` (weak candidates with a complement in scope: start, end, kind)."""
    if {"secrets", "linked"} & set(keep):
        raise ValueError("secrets and linked are columns of the result")
    t = F.coalesce(F.col(text), F.lit(""))
    both = let(t, lambda x: let(base_spans(x), lambda b: F.struct(b.alias("secrets"), linked(x, b).alias("linked"))))
    return docs.select(*keep, both.alias("__found")).select(*keep, "__found.secrets", "__found.linked")


def listing(spans: list[tuple[Column, str]], more: Column | None = None) -> Column:
    """kind:start:end of spans (arrays with their kinds, and one array with a kind in each
    row), by start and then by the order of the kinds, joined by commas."""
    order = F.create_map(*[x for i, k in enumerate(BASE_KINDS + WEAK_KINDS) for x in (F.lit(k), F.lit(i))])

    def row(p: Column, kind: Column) -> Column:
        return F.struct(p["start"].alias("s"), F.element_at(order, kind).alias("o"), F.concat_ws(
            ":", kind, p["start"].cast("string"), p["end"].cast("string")).alias("t"))

    def rows_of(a: Column, kind: str) -> Column:
        return F.transform(a, lambda p: row(p, F.lit(kind)))

    rows = [rows_of(a, k) for a, k in spans]
    if more is not None:
        rows.append(F.transform(more, lambda p: row(p, p["kind"])))
    return F.array_join(F.transform(F.sort_array(F.concat(*rows)), lambda x: x["t"]), ",")


def digest(found: DataFrame, keep: list[str]) -> DataFrame:
    """Counts of the base spans, the hash of their list and the list of all spans."""
    base = [(F.col(f"secrets.{k}"), k) for k in BASE_KINDS]
    return found.select(*keep, *[F.size(c).cast("long").alias(f"n_{k}") for c, k in base],
                        F.sha2(listing(base), 256).alias("base_sha256"),
                        listing(base, F.col("linked")).alias("spans"))


def _sql_matches(name: str, pattern: str, keep: str = "true", source: str = "d") -> str:
    quoted = pattern.replace("'", "''")
    return f"""{name} AS MATERIALIZED (SELECT rid, s AS s, s + length(m) AS e, m FROM (
  SELECT rid, m, sum(length(g) + length(m)) OVER (PARTITION BY rid ORDER BY i) - length(m) AS s FROM (
    SELECT rid, i, ms[i] AS m, gs[i] AS g FROM (
      SELECT rid, regexp_extract_all(t, '{quoted}') AS ms, string_split_regex(t, '{quoted}') AS gs FROM {source}),
    unnest(generate_series(1, len(ms))) AS u(i))) WHERE {keep})"""


def _sql() -> str:
    over = " AND ".join(f"NOT EXISTS (SELECT 1 FROM {k} b WHERE b.rid = w.rid AND b.s < w.e AND b.e > w.s)" for k in BASE_KINDS)
    value = ASSIGN_VALUE.replace("'", "''")
    weak = ",\n".join(f"w_{k} AS MATERIALIZED (SELECT * FROM r_{k} w WHERE {over})" for k in WEAK_KINDS)
    near = lambda other: (f"EXISTS (SELECT 1 FROM {other} c WHERE c.rid = p.rid AND c.s < p.hi AND c.e > p.lo)")
    identified = f"({near('access')} OR {near('w_identifier')})"
    keyed = f"({near('assign')} OR {near('hex')} OR {near('w_secret')})"
    rule = {"secret": f"({identified} OR {near('w_endpoint')})", "identifier": keyed, "endpoint": f"({identified} AND {keyed})"}
    scoped = lambda k: f"""(SELECT w.*, greatest(s - {REACH}, coalesce((SELECT max(b.e) FROM breaks b WHERE b.rid = w.rid AND b.e <= w.s), 0)) AS lo,
    least(e + {REACH}, coalesce((SELECT min(b.s) FROM breaks b WHERE b.rid = w.rid AND b.e > w.s), 2147483647)) AS hi FROM w_{k} w)"""  # noqa: E731
    spans = " UNION ALL ".join(
        [f"SELECT rid, s, e, '{k}' AS k, {i} AS o, true AS base FROM {k}" for i, k in enumerate(BASE_KINDS)]
        + [f"SELECT rid, s, e, '{k}', {i + 3}, false FROM {scoped(k)} p WHERE {rule[k]}" for i, k in enumerate(WEAK_KINDS)])
    told = "k || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT)"
    n = ", ".join(f"CAST(count(*) FILTER (k = '{k}') AS BIGINT) AS n_{k}" for k in BASE_KINDS)
    return f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
{_sql_matches('assign', ASSIGN, f"length(regexp_extract(m, '{value}', 1)) >= {LEAST_VALUE}")},
{_sql_matches('access', ACCESS)},
{_sql_matches('hex', HEX)},
{_sql_matches('breaks', BLANK_LINE)},
{_sql_matches('r_secret', WEAK_SECRET, "regexp_matches(m, '[:=]') OR (regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[0-9]'))")},
{_sql_matches('r_identifier', IDENTIFIER)},
{_sql_matches('r_endpoint', ENDPOINT)},
{weak},
spans AS ({spans}),
per AS (SELECT rid, {n}, string_agg({told}, ',' ORDER BY s, o) FILTER (base) AS b, string_agg({told}, ',' ORDER BY s, o) AS a
        FROM spans GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans
FROM d LEFT JOIN per USING (rid)"""


#: The same rows in DuckDB SQL.
SQL = _sql()
