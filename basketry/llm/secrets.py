"""Secret scan: known forms, and a randomness test battery for the rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from basketry.llm.common import fresh, let, whole_text
from basketry.llm.spans import spans
from basketry.materialize import stored

#: Fixed patterns of the known forms.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"

KINDS = ("assign", "access", "hex", "random")
ALPHABETS = {
    "hex": (r"^(?:[0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    "base32": (r"^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    "base36": (r"^[0-9a-z]+$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    "base62": (r"^[0-9A-Za-z]+$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    "base64": (r"^[0-9A-Za-z+/]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    "base64url": (r"^[0-9A-Za-z_-]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
}
LEAST_FIT = 0.001
FALSE_DISCOVERIES = 0.05
#: Share of neighbouring characters of different class (lower, upper, digit) granted to written words.
WORD_SWITCHES = 0.25
STEPS = 10


def upper_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal for z >= 0: a published rational approximation (fixed values)."""
    t = 1.0 / (1.0 + 0.2316419 * z)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.greatest(F.exp(-z * z / 2) * 0.3989422804014327 * poly, F.lit(1e-300))


def two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), 2 * upper_tail(F.abs(z)))


def one_sided(z: Column) -> Column:
    return F.when(z >= 0, upper_tail(z)).otherwise(1 - upper_tail(-z))


def battery(tokens: Column) -> Column:
    """For ``start, end, token, alphabet`` how well the token fits independent uniform draws from the
    alphabet, as ``start, end, token, fit``: a p-value.

    Chi-squared of the letter counts (normal approximation with the exact multinomial mean and
    variance), runs above and below the middle of the alphabet, and lag-1 serial correlation of
    the letter numbers, joined by Fisher's method. Each step hands its numbers to the next.
    """

    def letters(r: Column) -> Column:
        a = F.length(r["alphabet"]).cast("double")
        t = F.when(r["alphabet"] == ALPHABETS["hex"][1], F.lower(r["token"])).otherwise(r["token"])
        return F.struct(*_kept(r), r["alphabet"].alias("alphabet"), t.alias("t"), a.alias("a"), F.split(t, "").alias("letters"))

    def numbers(r: Column) -> Column:
        at = F.transform(r["letters"], lambda c: F.instr(r["alphabet"], c).cast("double") - (r["a"] + 1) / 2)
        squares = F.aggregate(
            F.array_distinct(r["letters"]),
            F.lit(0.0),
            lambda s, c: s + F.pow(F.length(r["t"]) - F.length(F.replace(r["t"], c, F.lit(""))), F.lit(2.0)),
        )
        return F.struct(*_kept(r), r["a"].alias("a"), F.size(r["letters"]).cast("double").alias("n"), at.alias("at"), squares.alias("squares"))

    def sums(r: Column) -> Column:
        before, after = F.slice(r["at"], 1, F.size(r["at"]) - 1), F.slice(r["at"], 2, F.size(r["at"]) - 1)
        count = lambda xs: F.aggregate(xs, F.lit(0.0), lambda s, x: s + x)
        turns = F.zip_with(before, after, lambda x, y: F.when(F.signum(x) != F.signum(y), 1.0).otherwise(0.0))
        return F.struct(
            *_kept(r), r["a"].alias("a"), r["n"].alias("n"), r["squares"].alias("squares"),
            (1 + count(turns)).alias("runs"),
            count(F.transform(r["at"], lambda x: F.when(x > 0, 1.0).otherwise(0.0))).alias("high"),
            count(F.zip_with(before, after, lambda x, y: x * y)).alias("serial"),
        )

    def scores(r: Column) -> Column:
        a, n = r["a"], r["n"]
        mean = 2 * r["high"] * (n - r["high"]) / n + 1
        spread = (mean - 1) * (mean - 2) / (n - 1)
        return F.struct(
            *_kept(r),
            ((r["squares"] * a / n - n - (a - 1)) / F.sqrt(2 * (a - 1) * (n - 1) / n)).alias("chi"),
            F.when(spread > 0, (r["runs"] - mean) / F.sqrt(spread)).otherwise(F.lit(40.0)).alias("runs"),
            (r["serial"] / (F.sqrt(n - 1) * ((a * a - 1) / 12))).alias("serial"),
        )

    def half(r: Column) -> Column:
        joined = -(F.ln(one_sided(r["chi"])) + F.ln(two_sided(r["runs"])) + F.ln(two_sided(r["serial"])))
        return F.struct(*_kept(r), joined.alias("half"))

    def fit(r: Column) -> Column:
        p = F.exp(-r["half"]) * (1 + r["half"] + r["half"] * r["half"] / 2)
        return F.struct(*_kept(r), p.alias("fit"))

    for step in (letters, numbers, sums, scores, half, fit):
        tokens = F.transform(tokens, step)
    return tokens


def _kept(r: Column) -> list[Column]:
    return [r[c].alias(c) for c in ("start", "end", "token")]


def wordlikeness(token: Column) -> Column:
    """A bound on the chance that a written word or name of this length changes between lower case,
    upper case and digits as often as the token does (Chernoff bound for the binomial)."""
    q = WORD_SWITCHES

    def bound(x: Column) -> Column:
        share, gaps = x["share"], x["gaps"]
        rest = F.when(share < 1, (1 - share) * F.ln((1 - share) / (1 - q))).otherwise(0.0)
        return F.when(share > q, F.exp(-gaps * (share * F.ln(share / q) + rest))).otherwise(1.0)

    def shares(t: Column) -> Column:
        gaps = F.greatest(F.length(t) - 1, F.lit(1)).cast("double")
        groups = F.regexp_count(t, F.lit("[a-z]+|[A-Z]+|[0-9]+")).cast("double")
        return F.struct(gaps.alias("gaps"), F.least((groups - 1) / gaps, F.lit(1.0)).alias("share"))

    return let(let(F.regexp_replace(token, "[^0-9A-Za-z]", ""), shares), bound)


def scan_secrets(
    docs: DataFrame, least_fit: float = LEAST_FIT, false_discoveries: float = FALSE_DISCOVERIES
) -> DataFrame:
    """``docs`` less ``text`` with ``base`` and ``all_spans``: arrays of ``start, rank, kind, end``.

    Base spans are assignments of at least 8 characters, access keys of at least 16 and hex runs of
    at least 32. Other runs of 20 or more key characters are candidates unless they touch a base span.
    A candidate's encoding is the smallest alphabet that holds it (only digits: none). It is added
    if the battery does not reject uniform draws from that alphabet, and if its p-value
    against written words, which falls with length, stands up to a false-discovery bound over the
    candidates of all rows. That bound needs only how many candidates have which rounded p-value,
    so one small table is gathered whatever the input.

    Null and empty text have no spans. Positions count code points. Repeated rows are rows of their
    own and each adds its candidates. Empty input gives an empty result.
    """
    text = whole_text()
    base: list[Column] = []
    for rank, (kind, pattern, group, least) in enumerate(
        (("assign", ASSIGN, 1, 8), ("access", ACCESS, 0, 16), ("hex", HEX, 0, 32))
    ):
        good = F.filter(spans(text, pattern, group), _at_least(least))
        base.append(F.transform(good, _named(rank, kind)))
    rest = [c for c in docs.columns if c not in ("text", "base", "candidates", "all_spans")]

    def candidates(known: Column) -> Column:
        free = F.filter(
            spans(text, CANDIDATE),
            lambda r: ~r["found"].rlike("^[0-9=]+$")
            & ~F.exists(known, lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])),
        )
        return F.struct(F.sort_array(known).alias("base"), _judged(free).alias("candidates"))

    (both,) = fresh(docs, "found")
    found = docs.select(*rest, let(F.concat(*base), candidates).alias(both))
    found = stored(found.select(*rest, f"{both}.base", f"{both}.candidates"), "spans")

    steps = (
        found.select(F.explode("candidates").alias("c")).groupBy(F.col("c.step").alias("step")).agg(F.count(F.lit(1)).alias("n"))
    )
    down = Window.orderBy(F.col("step").desc())
    limit = (
        steps.withColumn("m", F.sum("n").over(Window.partitionBy()))
        .withColumn("k", F.sum("n").over(down))
        .where(F.pow(F.lit(10.0), -F.col("step") / STEPS) <= F.lit(false_discoveries) * F.col("k") / F.col("m"))
        .agg(F.min("step").alias("least"))
        .first()["least"]
    )
    random = F.array().cast(_SPANS) if limit is None else F.transform(
        F.filter("candidates", lambda c: (c["step"] >= limit) & (c["fit"] >= least_fit)),
        _named(3, "random"),
    )
    return found.select(*rest, "base", F.sort_array(F.concat("base", random)).alias("all_spans"))


_SPANS = "array<struct<start:bigint,rank:int,kind:string,end:bigint>>"


def _at_least(least: int):
    return lambda s: F.length(s["value"]) >= least


def _named(rank: int, kind: str):
    return lambda s: F.struct(
        s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["end"].alias("end")
    )


def _judged(runs: Column) -> Column:
    def named(r: Column) -> Column:
        token = F.regexp_replace(r["found"], "=+$", "")
        alphabet = F.lit(ALPHABETS["base64"][1])
        for pattern, letters in reversed(ALPHABETS.values()):
            alphabet = F.when(token.rlike(pattern), letters).otherwise(alphabet)
        return F.struct(r["start"].alias("start"), r["end"].alias("end"), token.alias("token"), alphabet.alias("alphabet"))

    def stepped(r: Column) -> Column:
        step = let(wordlikeness(r["token"]), lambda p: F.least(F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * STEPS), F.lit(3000)))
        return F.struct(r["start"].alias("start"), r["end"].alias("end"), r["fit"].alias("fit"), step.cast("int").alias("step"))

    return F.transform(battery(F.transform(runs, named)), stepped)


def span_text(c: str) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def kind_count(c: str, kind: str) -> Column:
    return F.size(F.filter(c, lambda s: s["kind"] == kind)).cast("long")
