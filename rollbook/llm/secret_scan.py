"""Secrets in texts: fixed patterns, and tokens that look random.

Columns only: every pattern is run by ``split`` (what lies between matches) and
``regexp_extract_all`` (the matches), whose lengths in turn give the spans.

Beyond the patterns, runs of 20 and more token characters with a digit are put to a
battery of tests. The narrowest alphabet that has all characters of a token is its
inferred encoding; on the positions in that alphabet are computed

* chi-squared: are all symbols equally frequent,
* runs: does the sequence change between lower and upper half as often as chance has it,
* serial correlation: does a symbol tell the next one.

A token is random if it passes these together (Fisher's method). Short tokens pass
easily, so it must also be improbable as natural text of its length: under natural
symbol frequencies chi-squared grows with the length, and the probability of a value
as low as the one seen is the token's p-value, which is weak for short tokens. These
p-values are put under false-discovery control (Benjamini-Hochberg) within each
encoding and length band, over all tokens of the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollbook.session import land

# fixed values: patterns of the base kinds, in the order of the report, and the least length of what is kept
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "random")
ASSIGN_LEAST = 12

TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
# fixed values: encodings from the narrowest on: name, what a token of it looks like, its symbols
_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ENCODINGS = (
    ("hex", "^[0-9a-f]+$", _DIGITS + "abcdef"),
    ("upper hex", "^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    ("base32", "^[A-Z2-7]+=*$", _UPPER + "234567"),
    ("upper base36", "^[0-9A-Z]+$", _DIGITS + _UPPER),
    ("lower base36", "^[0-9a-z]+$", _DIGITS + _LOWER),
    ("base62", "^[0-9A-Za-z]+$", _DIGITS + _UPPER + _LOWER),
    ("base64", "", _UPPER + _LOWER + _DIGITS + "+/-_"),
)
#: Probability that two symbols of natural text are the same, and the least of it against a uniform alphabet's.
NATURAL_REPEAT, NATURAL_FACTOR = 0.0667, 1.6
#: Share of false discoveries, and the level of the randomness tests.
FALSE_DISCOVERIES, RANDOM_LEVEL = 0.05, 0.001


def matches(text: str, pattern: str) -> Column:
    """Leftmost non-overlapping matches in a column: array of (start, end, token), in code points, end exclusive."""
    quoted = pattern.replace("\\", "\\\\").replace("'", "\\'")
    found = f"regexp_extract_all({text}, '{quoted}', 0)"
    return F.expr(
        f"""aggregate(
              zip_with({found}, slice(split({text}, '{quoted}', -1), 1, size({found})), (token, gap) -> struct(token, gap)),
              named_struct('at', 0, 'spans', cast(array() as array<struct<start:int,end:int,token:string>>)),
              (a, x) -> named_struct('at', a.at + length(x.gap) + length(x.token), 'spans', concat(a.spans, array(
                named_struct('start', a.at + length(x.gap), 'end', a.at + length(x.gap) + length(x.token), 'token', x.token)))),
              a -> a.spans)"""
    )


def _ranked(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of spans (start, kind number, end), comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def normal_tail(z: Column) -> Column:
    """P(|Z| > |z|) of a standard normal variable, to 1e-7 (a polynomial in 1 / (1 + p x))."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.3275911) * x)
    # fixed values: coefficients of the approximation of the error function
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.least(F.lit(1.0), poly * F.exp(-x * x))


def below(z: Column) -> Column:
    """P(Z < z) of a standard normal variable."""
    return F.when(z < 0, normal_tail(z) / 2).otherwise(1 - normal_tail(z) / 2)


def token_tests(tokens: DataFrame) -> DataFrame:
    """The columns of ``tokens (token, ...)`` with ``encoding, band, p_random`` and ``p_natural``."""

    def pick(value) -> Column:
        chosen = F.lit(value(ENCODINGS[-1]))
        for e in reversed(ENCODINGS[:-1]):
            chosen = F.when(F.col("token").rlike(e[1]), F.lit(value(e))).otherwise(chosen)
        return chosen

    symbols = tokens.withColumns({"encoding": pick(lambda e: e[0]), "alphabet": pick(lambda e: e[2])}).withColumn(
        "x", F.expr("transform(filter(split(token, ''), c -> c <> '=' and c <> ''), c -> instr(alphabet, c) - 1)")
    )
    m, n = F.length("alphabet"), F.size("x")
    counts = F.expr("aggregate(map_values(aggregate(x, cast(map() as map<int,bigint>), (a, v) -> map_concat(map_filter(a, (k, c) -> k <> v), map(v, coalesce(a[v], 0L) + 1L)))), 0L, (a, c) -> a + c * c)")
    sides = F.expr("transform(x, v -> if(2 * v < length(alphabet), 0, 1))")
    s = symbols.withColumns({"m": m.cast("double"), "n": n.cast("double"), "squares": counts.cast("double"), "side": sides})
    s = s.withColumns(
        {
            "upper": F.expr("aggregate(side, 0, (a, v) -> a + v)").cast("double"),
            "changes": F.expr("aggregate(zip_with(slice(side, 1, size(side) - 1), slice(side, 2, size(side) - 1), (a, b) -> if(a <> b, 1, 0)), 0, (a, v) -> a + v)").cast("double"),
            "mean": F.expr("aggregate(x, 0L, (a, v) -> a + v)") / F.col("n"),
        }
    )
    s = s.withColumns(
        {
            "chi": F.col("m") / F.col("n") * F.col("squares") - F.col("n"),
            "spread": F.expr("aggregate(x, 0D, (a, v) -> a + (v - mean) * (v - mean))"),
            "lagged": F.expr("aggregate(zip_with(slice(x, 1, size(x) - 1), slice(x, 2, size(x) - 1), (a, b) -> (a - mean) * (b - mean)), 0D, (a, v) -> a + v)"),
        }
    )
    lower = F.col("n") - F.col("upper")
    expected = 2 * F.col("upper") * lower / F.col("n") + 1
    spread_runs = (expected - 1) * (expected - 2) / (F.col("n") - 1)
    z_chi = (F.col("chi") - (F.col("m") - 1)) / F.sqrt(2 * (F.col("m") - 1) * (F.col("n") - 1) / F.col("n"))
    z_runs = F.when(spread_runs > 0, (F.col("changes") + 1 - expected) / F.sqrt(spread_runs)).otherwise(F.lit(9.0))
    z_serial = F.when(F.col("spread") > 0, (F.col("lagged") / F.col("spread") + 1 / F.col("n")) * F.sqrt("n")).otherwise(F.lit(9.0))
    fisher = -(F.log(F.greatest(1 - below(z_chi), F.lit(1e-300))) + F.log(F.greatest(normal_tail(z_runs), F.lit(1e-300))) + F.log(F.greatest(normal_tail(z_serial), F.lit(1e-300))))
    natural = F.greatest(F.lit(NATURAL_REPEAT), F.lit(NATURAL_FACTOR) / F.col("m"))
    shift = (F.col("n") - 1) * (F.col("m") * natural - 1)
    z_natural = (F.col("chi") - (F.col("m") - 1) - shift) / F.sqrt(2 * (F.col("m") - 1 + 2 * shift))
    out = s.withColumns({"fisher": fisher, "p_natural": below(z_natural), "band": F.floor(F.log2("n") * 2).cast("int")})
    # the sum of three logarithms has a chi-squared tail with a closed form
    p_random = F.exp(-F.col("fisher")) * (1 + F.col("fisher") + F.col("fisher") * F.col("fisher") / 2)
    return out.withColumn("p_random", p_random).select(*tokens.columns, "encoding", "band", "p_random", "p_natural")


def discovery_limits(tested: DataFrame, share: float = FALSE_DISCOVERIES) -> DataFrame:
    """``(encoding, band, limit)``: the p-value up to which tokens of a stratum may be called discoveries.

    P-values are counted in steps of a fiftieth of a decade, so a stratum has at most
    1,500 rows however many tokens there are.
    """
    step = F.ceil(F.log10(F.greatest("p_natural", F.lit(1e-30))) * 50).cast("int")
    binned = tested.groupBy("encoding", "band", step.alias("step")).agg(F.count("*").alias("n"))
    stratum = W.partitionBy("encoding", "band")
    ranked = binned.withColumns({"upto": F.sum("n").over(stratum.orderBy("step")), "all": F.sum("n").over(stratum), "p": F.pow(F.lit(10.0), F.col("step") / 50)})
    return ranked.where(F.col("p") * F.col("all") <= F.lit(share) * F.col("upto")).groupBy("encoding", "band").agg(F.max("p").alias("limit"))


def scan(docs: DataFrame, share: float = FALSE_DISCOVERIES) -> DataFrame:
    """``doc_id`` and ``spans``, array of (start, kind number in KINDS, end) by start, then kind.

    One row per row of ``docs``; null and empty texts have no span; other columns are
    ignored. Random tokens that overlap a span of a pattern are not reported again.
    The function starts jobs: one pass over the texts, which lands spans and tokens,
    then the tests of the tokens.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    assigned = F.filter(matches("text", ASSIGN), lambda s: F.length(F.regexp_extract(s["token"], ASSIGN, 2)) >= ASSIGN_LEAST)
    base = F.array_sort(F.concat(_ranked(assigned, 0), _ranked(matches("text", ACCESS), 1), _ranked(matches("text", HEX), 2)))
    tokens = F.filter(matches("text", TOKEN), lambda s: s["token"].rlike("[0-9]"))
    found = land(texts.select("doc_id", base.alias("base"), tokens.alias("tokens")).withColumn("row", F.monotonically_increasing_id()), "secrets")
    tested = land(token_tests(found.select("row", F.explode("tokens").alias("t")).select("row", "t.start", "t.end", "t.token")), "token-tests")
    limits = land(discovery_limits(tested, share), "limits")
    random = (
        tested.join(limits, ["encoding", "band"])
        .where((F.col("p_natural") <= F.col("limit")) & (F.col("p_random") >= RANDOM_LEVEL))
        .groupBy("row")
        .agg(F.collect_list(F.struct("start", F.lit(len(KINDS) - 1).alias("kind"), "end")).alias("random"))
    )
    apart = F.filter("random", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    return found.join(random, "row", "left").select("doc_id", F.array_sort(F.concat("base", F.coalesce(apart, F.expr("slice(base, 1, 0)")))).alias("spans"))
