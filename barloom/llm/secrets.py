r"""Secret scans with DataFrame functions only: three base patterns and a battery of randomness tests.

All matches of a pattern get a mark on both sides (one ``regexp_replace``); splitting at the mark gives gaps and
matches in turn, whose summed lengths are the spans in code points.

Further candidates are long runs of token characters. The narrowest alphabet that holds a candidate is its
inferred encoding. The battery: a chi-squared statistic of the symbol counts against a uniform alphabet, runs
tests about the mean symbol and of letters and digits, and the lag-1 serial correlation. Ordinary words put a known
surplus per character on the chi-squared statistic, so its lower tail under that law is the chance that words look
this uniform; it falls with length. In encodings of letters and digits, names keep both in few runs; Chernoff's bound
on as many changes as there are is a second chance, and Fisher's method combines the two. Within each class of
lengths, false discoveries are controlled over all candidates of the corpus (Benjamini-Hochberg on a histogram of
p-values); the runs about the mean and the serial correlation must not speak against randomness.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import cut

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = ("assign", "access", "hex", "random")
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"
#: Chance that two characters of ordinary words in Latin letters agree (their index of coincidence): English 0.067,
#: German and Spanish 0.076, evenly used letters 0.038. A low value calls less of the text random.
COINCIDENCE = 0.065
#: Encoding: pattern, size of the alphabet, whether words can look like it. Words put alphabet * COINCIDENCE - 1 more on
#: the chi-squared statistic for each character than random symbols do; in hex, where words have six letters only, they
#: put about 10 more of 16 symbols aside, of which digits mixed in take most back: 0.6. Decimals are never secrets.
ENCODINGS = (
    ("decimal", "^[0-9]+$", 10, None),
    ("hex", "^([0-9a-f]+|[0-9A-F]+)$", 16, 0.6),
    *((name, pattern, k, k * COINCIDENCE - 1) for name, pattern, k in (
        ("letters", "^([a-z]+|[A-Z]+)$", 26),
        ("joined words", "^([a-z+/_-]+|[A-Z+/_-]+)$", 30),
        ("base32", "^[A-Z2-7]+$", 32),
        ("base36", "^([a-z0-9]+|[A-Z0-9]+)$", 36),
        ("base64", "^[A-Za-z0-9+/_-]+$", 64),
    )),
)
#: Share of false finds among the tokens called secret; largest deviation that the runs and serial tests allow.
FDR, MAX_Z = 0.01, 3.0
BINS = 60
#: Chance that names change between letters and digits from one character to the next: once in eight characters.
CHANGES = 0.125
#: Encodings of letters and digits, which names may hold in a few runs.
MIXED = ("hex", "base32", "base36")
#: What a text with an assignment holds, in lower case.
ASSIGNED = ("password", "passwd", "secret", "token", "apikey", "api_key")
MARK, INSTEAD = "\u0001", "\u0002"


#: Parts of a text that one fold gathers (an even number, so that each starts with a gap).
FOLD = 256
SPANS = "array<struct<start:int,end:int,token:string>>"


def matches(text: Column, pattern: str, keep=lambda m: F.lit(True)) -> Column:
    """array<struct<start int, end int, token string>> of the leftmost non-overlapping matches that ``keep`` accepts.

    Gaps and matches are folded FOLD at a time, because a fold copies what it has gathered with each match.
    """
    parts = F.split(F.regexp_replace(F.replace(text, F.lit(MARK), F.lit(INSTEAD)), pattern, f"{MARK}$0{MARK}"), MARK)
    empty = F.array().cast(SPANS)

    def step(acc: Column, part: Column) -> Column:
        end = acc["at"] + F.length(part)
        one = F.array(F.struct(acc["at"].alias("start"), end.alias("end"), part.alias("token")))
        return F.struct(
            end.alias("at"),
            (~acc["hit"]).alias("hit"),
            F.when(acc["hit"] & keep(part), F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"),
        )

    def fold(at: Column, some: Column) -> Column:
        return F.aggregate(some, F.struct(at.alias("at"), F.lit(False).alias("hit"), empty.alias("out")), step, lambda acc: acc["out"])

    def folds(parts: Column) -> Column:
        """Each FOLD parts with the place where they start."""
        some = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / FOLD).cast("int")), lambda i: F.slice(parts, i * FOLD + 1, F.lit(FOLD)))
        first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
        width = lambda some: F.aggregate(some, F.lit(0), lambda n, p: n + F.length(p))
        starts = F.aggregate(
            some,
            first,
            lambda acc, p: F.struct((acc["at"] + width(p)).alias("at"), F.concat(acc["starts"], F.array(acc["at"])).alias("starts")),
            lambda acc: acc["starts"],
        )
        return F.zip_with(starts, some, lambda at, p: fold(at, p))

    return F.when(F.size(parts) > FOLD, F.flatten(folds(parts))).when(F.size(parts) > 1, fold(F.lit(0), parts)).otherwise(empty)


def _lower_tail(z: Column) -> Column:
    """The normal distribution function, by the usual five-term polynomial."""
    a = F.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-a * a / 2) * 0.3989422804014327 * poly
    return F.when(z < 0, upper).otherwise(1 - upper)


def once(value: Column, then) -> Column:
    """``then`` of a value that is made once, however often it is used."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _few_changes(changes: Column, steps: Column) -> Column:
    """Logarithm of a bound on the chance that names change between letters and digits that often (Chernoff)."""
    share = changes / steps
    more = share * F.ln(share / CHANGES) + F.coalesce((1 - share) * F.ln((1 - share) / (1 - CHANGES)), F.lit(0.0))
    return F.when(share > CHANGES, -steps * more).otherwise(0.0)


def battery(token: Column) -> Column:
    """struct(len_class int, bin int): the class of lengths and the decimal exponent (quartered) of the p-value.

    Bin 0 also takes what the runs or serial test rejects, and decimal numbers.
    """
    body = F.regexp_replace(token, "[=]+$", "")
    law = lambda k, extra, mixed: F.struct(F.lit(float(k)).alias("k"), F.lit(extra).cast("double").alias("lam"), F.lit(mixed).alias("mixed"))
    of = law(64, 64 * COINCIDENCE - 1, False)
    for name, pattern, k, extra in reversed(ENCODINGS):
        of = F.when(body.rlike(pattern), law(k, extra, name in MIXED)).otherwise(of)
    made = F.struct(F.upper(body).alias("up"), body.alias("body"), of.alias("law"))

    def symbols(m: Column) -> Column:
        """The places of the characters in the alphabet, from 1; digits are the first ten."""
        places = F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ")
        small, big = F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/-_"), m["law"]["k"] == 64
        chars = F.filter(F.split(F.when(big, m["body"]).otherwise(m["up"]), ""), lambda c: c != "")
        at = F.transform(chars, lambda c: F.instr(F.when(big, small).otherwise(places), c).cast("double"))
        return F.struct(at.alias("x"), m["law"].alias("law"))

    def sums(m: Column) -> Column:
        """Two folds: over the symbols in order, and over the sorted ones, whose runs give the sum of squared counts."""
        first = F.element_at(m["x"], 1)
        names = ("sum", "squares", "products", "changes", "last")
        start = F.struct(*(c.alias(n) for c, n in zip((F.lit(0.0), F.lit(0.0), -first * first, F.lit(0.0), first), names)))
        in_order = F.aggregate(m["x"], start, lambda s, v: F.struct(
            (s["sum"] + v).alias("sum"),
            (s["squares"] + v * v).alias("squares"),
            (s["products"] + s["last"] * v).alias("products"),
            (s["changes"] + ((s["last"] <= 10) != (v <= 10)).cast("double")).alias("changes"),
            v.alias("last"),
        ))

        def count(s: Column, v: Column) -> Column:
            run = F.when(s["last"] == v, s["run"] + 1).otherwise(1.0)
            return F.struct((s["total"] + 2 * run - 1).alias("total"), run.alias("run"), v.alias("last"))

        start = F.struct(F.lit(0.0).alias("total"), F.lit(0.0).alias("run"), F.lit(0.0).alias("last"))
        counts = F.aggregate(F.sort_array(m["x"]), start, count, lambda s: s["total"])
        return F.struct(m["x"].alias("x"), m["law"].alias("law"), in_order.alias("of"), counts.alias("counts"))

    def about_mean(m: Column) -> Column:
        """How many symbols are above the mean, and the runs of those above and below."""
        mean = m["of"]["sum"] / F.size(m["x"])
        start = F.struct(F.lit(0.0).alias("ups"), F.lit(1.0).alias("runs"), (F.element_at(m["x"], 1) > mean).alias("high"))
        runs = F.aggregate(m["x"], start, lambda s, v: F.struct(
            (s["ups"] + (v > mean).cast("double")).alias("ups"),
            (s["runs"] + (s["high"] != (v > mean)).cast("double")).alias("runs"),
            (v > mean).alias("high"),
        ))
        return F.struct(*(m[c].alias(c) for c in ("x", "law", "of", "counts")), runs.alias("mean"))

    def statistics(m: Column) -> Column:
        x, k, lam, of, n = m["x"], m["law"]["k"], m["law"]["lam"], m["of"], F.size(m["x"]).cast("double")
        mean, ups = of["sum"] / n, m["mean"]["ups"]
        spread = 2 * ups * (n - ups)
        runs_z = F.try_divide(m["mean"]["runs"] - spread / n - 1, F.sqrt(F.greatest(F.lit(0.0), spread * (spread - n) / (n * n * (n - 1)))))
        lag = of["products"] - mean * (2 * of["sum"] - F.element_at(x, 1) - of["last"]) + (n - 1) * mean * mean
        serial_z = (F.try_divide(lag, of["squares"] - of["sum"] * mean) + 1 / n) * F.sqrt(n)
        word = lam * n
        p = F.greatest(_lower_tail((k / n * m["counts"] - n - word - (k - 1)) / F.sqrt(2 * (k - 1) + 4 * word)), F.lit(1e-30))
        both = F.ln(p) + _few_changes(of["changes"], n - 1)
        p = F.greatest(F.when(m["law"]["mixed"], F.exp(both) * (1 - both)).otherwise(p), F.lit(1e-30))
        fits = (F.abs(F.coalesce(runs_z, F.lit(99.0))) <= MAX_Z) & (F.abs(F.coalesce(serial_z, F.lit(99.0))) <= MAX_Z)
        place = F.least(F.lit(BINS), F.floor(-4 * F.log10(p)).cast("int"))
        return F.struct(F.floor(F.log2(n)).cast("int").alias("len_class"), F.when(fits & lam.isNotNull(), place).otherwise(0).alias("bin"))

    return once(once(once(once(made, symbols), sums), about_mean), statistics)


def with_candidates(df: DataFrame, text: Column) -> DataFrame:
    """``df`` with ``__base`` (spans of the base kinds) and ``__tokens`` (candidates that touch no base span)."""
    text = F.coalesce(text, F.lit(""))
    spans = lambda kind, found: F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end")))
    # what the base patterns need is looked for first: a word of an assignment, and a token, as long as each hit is one
    assigned = once(F.lower(text), lambda low: reduce(Column.__or__, (F.contains(low, F.lit(w)) for w in ASSIGNED)))
    none, some = F.array().cast(SPANS), F.size("__tokens") > 0
    base = F.concat(
        spans(0, F.when(assigned, matches(text, ASSIGN, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6)).otherwise(none)),
        spans(1, F.when(some & F.contains(text, F.lit("AKIA")), matches(text, "AKIA[A-Z0-9]+", lambda m: F.length(m) >= 20)).otherwise(none)),
        spans(2, F.when(some, matches(text, "(?<![0-9a-f])[0-9a-f]{24,}")).otherwise(none)),
    )
    df = df.withColumn("__tokens", matches(text, TOKEN)).withColumn("__base", F.array_sort(base))
    apart = F.filter("__tokens", lambda t: ~F.exists("__base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    return df.withColumn(
        "__tokens",
        F.transform(apart, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), battery(t["token"]).alias("b"))),
    )


def thresholds(found: DataFrame, fdr: float = FDR) -> dict[int, int]:
    """By class of lengths, the lowest bin called secret: at most one number for each power of two of lengths."""
    cells = found.select(F.explode("__tokens").alias("t")).groupBy(F.col("t.b.len_class").alias("c"), F.col("t.b.bin").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"),
    )
    by: dict[int, dict[int, int]] = {}
    for c, b, n in cells.collect():  # at most 31 classes times BINS + 1 bins
        by.setdefault(c, {})[b] = n
    out = {}
    for c, bins in by.items():
        total, above = sum(bins.values()), 0
        for b in sorted(bins, reverse=True):
            above += bins[b]
            if b > 0 and 10 ** (-b / 4) <= fdr * above / total:
                out[c] = b
    return out


def scan(df: DataFrame, text: str = "text", drop_text: bool = False, fdr: float = FDR) -> DataFrame:
    """``df`` with ``secret_spans``: array<struct<start, kind, end>> by start, then kind (a place in KINDS).

    Null text is empty and has no spans. Spans count code points, ends exclusive. Repeated rows get the same spans;
    columns named ``secret_spans`` or ``__*`` are replaced; an empty table gives an empty result.
    """
    keep = [c for c in df.columns if c != "secret_spans" and not c.startswith("__") and not (drop_text and c == text)]
    found = cut(with_candidates(df.select(*df.columns), F.col(text)).select(*keep, "__base", "__tokens"), "secrets")
    from_class = thresholds(found, fdr)
    pairs = [F.lit(x) for c, b in sorted(from_class.items()) for x in (c, b)]
    limit = F.create_map(*pairs) if pairs else F.create_map(F.lit(-1), F.lit(BINS + 1))
    secret = F.filter("__tokens", lambda t: t["b"]["bin"] >= F.coalesce(F.element_at(limit, t["b"]["len_class"]), F.lit(BINS + 1)))
    more = F.transform(secret, lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end")))
    return found.select(*keep, F.array_sort(F.concat("__base", more)).alias("secret_spans"))


def written(spans: Column) -> Column:
    """kind:start:end of every span, joined with commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def redacted(text: Column, spans: Column, instead: str = "[SECRET]") -> Column:
    """``text`` with every run of overlapping spans replaced; null stays null."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        first = fresh & ((s["start"] > acc["at"]) | (acc["out"] == ""))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(first, F.concat(acc["out"], gap, F.lit(instead))).otherwise(acc["out"]).alias("out"),
        )

    whole = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, digest and list of the secrets in every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan(docs, drop_text=True)
    of = lambda k: F.filter("secret_spans", lambda s: s["kind"] == k)
    base = F.filter("secret_spans", lambda s: s["kind"] < 3)
    counts = [F.size(of(k)).cast("bigint").alias(f"n_{KINDS[k]}") for k in range(3)]
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("secret_spans")).alias("spans"))
