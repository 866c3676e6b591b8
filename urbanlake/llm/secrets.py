"""Secret scanning: fixed patterns, and a battery of randomness tests on every long token.

A token is a run of ``[A-Za-z0-9+/_=-]`` of ``MIN_TOKEN`` characters or more. Its encoding is inferred from its characters
(decimal, hexadecimal, base 32, base 36, base 64), which gives the alphabet's size ``m``. Three tests hold it against a
uniform random string of its length ``n`` over that alphabet:

- chi-squared uniformity, standardised with the exact moments for ``n`` draws (mean ``m - 1``, variance
  ``2 (m - 1) (1 - 1 / n)``), one-sided;
- runs above and below the middle of the alphabet (mean ``(n + 1) / 2``, variance ``(n - 1) / 4``), two-sided;
- lag-one serial correlation of the symbols (mean ``-1 / n``, variance ``1 / n``), two-sided.

A token of fewer than two symbols, as a row of ``=``, has nothing to test: both its p are 1, so it is no secret.

Fisher's method combines them; a token at which randomness is rejected is no secret. What remains must also be a discovery
against ordinary text: its coincidence index is held against that of text (``TEXT_COINCIDENCE``), with a deviation that
shrinks with the length, and Benjamini-Hochberg picks the discoveries among the tokens of a length band at rate ``rate``.
Short tokens thus need a clearer case than long ones. The ranks come from a histogram of bounded size, so no sort holds
all tokens; a bin counts with its larger p, which errs on the careful side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from urbanlake.llm.common import query, table
from urbanlake.session import stage

# Patterns and least lengths of the three base kinds.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
KINDS = ["assign", "access", "hex", "random"]

MIN_TOKEN = 20
TOKEN = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{MIN_TOKEN},}}+"
TEXT_COINCIDENCE = 0.066
BANDS = [24, 32, 48, 96]
BIN = 0.05
BINS = 800


def running_sum(lengths: Column) -> Column:
    """Inclusive running sums of an array, by doubling: the work grows as n log n, not as n squared."""
    step = lambda a, k: F.when(
        F.size(a) > F.expr("1L") * F.pow(F.lit(2), k).cast("int"),
        F.transform(a, lambda x, i: x + F.when(i >= F.pow(F.lit(2), k).cast("int"), F.get(a, i - F.pow(F.lit(2), k).cast("int"))).otherwise(F.lit(0))),
    ).otherwise(a)
    return F.aggregate(F.sequence(F.lit(0), F.lit(30)), lengths, step)


def matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def positions(df: DataFrame, out: str, text: str, found: str, pattern: str) -> DataFrame:
    """Add ``out``: the start of each match in ``found``, from the lengths of matches and of what lies between them."""
    has = F.size(found) > 0
    between = F.when(has, F.transform(F.split(F.col(text), pattern, -1), F.length)).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("_between", between).withColumn("_sizes", F.transform(F.col(found), F.length))
    ends = F.transform(F.col("_sizes"), lambda n, i: n + F.get(F.col("_between"), i))
    df = df.withColumn("_ends", F.when(has, running_sum(ends)).otherwise(F.array().cast("array<int>")))
    return df.withColumn(out, F.transform(F.col("_ends"), lambda e, i: e - F.get(F.col("_sizes"), i))).drop("_between", "_sizes", "_ends")


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``spans`` (array of kind, start, end, word) of the base kinds, and ``tokens`` (array of start, end, word).

    Positions count code points, the end is exclusive. A null or empty text has none. Tokens that overlap a base span are
    left out. Columns of ``docs`` called ``spans``, ``tokens`` or ``_*`` are replaced.
    """
    df = docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    # Cheap searches decide whether a text needs a pattern at all.
    signs = F.contains("_text", F.lit("=")) | F.contains("_text", F.lit(":"))
    df = df.withColumn("_m0", F.when(signs, matches(F.col("_text"), ASSIGN)).otherwise(F.array().cast("array<string>")))
    df = df.withColumn("_v0", F.when(F.size("_m0") > 0, F.regexp_extract_all("_text", F.lit(ASSIGN), F.lit(2))).otherwise(F.array().cast("array<string>")))
    df = df.withColumn("_m1", F.when(F.contains("_text", F.lit("AKIA")), matches(F.col("_text"), ACCESS)).otherwise(F.array().cast("array<string>")))
    # Shorter hexadecimal runs fail anyway, and a long one lies in a token: only texts with tokens are searched, for long runs.
    long_hex = rf"(?<![0-9a-f])[0-9a-f]{{{HEX_LEAST},}}+"
    df = df.withColumn("_m3", matches(F.col("_text"), TOKEN))
    df = df.withColumn("_m2", F.when(F.size("_m3") > 0, matches(F.col("_text"), long_hex)).otherwise(F.array().cast("array<string>")))
    for i, pattern in enumerate((ASSIGN, ACCESS, long_hex, TOKEN)):
        df = positions(df, f"_p{i}", "_text", f"_m{i}", pattern)

    def spans(i: int, keep) -> Column:
        rows = F.transform(F.col(f"_m{i}"), lambda w, k: F.struct(F.lit(i).alias("kind"), F.get(F.col(f"_p{i}"), k).alias("start"), (F.get(F.col(f"_p{i}"), k) + F.length(w)).alias("end"), w.alias("word"), (F.length(F.get(F.col("_v0"), k)) if i == 0 else F.length(w)).alias("size")))
        return F.transform(F.filter(rows, keep), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["word"].alias("word")))

    least = [ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST]
    at_least = lambda n: lambda s: s["size"] >= n
    base = F.concat(*(spans(i, at_least(n)) for i, n in enumerate(least)))
    df = df.withColumn("spans", base)
    free = F.filter(spans(3, lambda s: F.lit(True)), lambda t: ~F.exists(F.col("spans"), lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])))
    return df.withColumn("tokens", free).drop(*[c for c in df.columns if c.startswith("_")])


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution by a logistic curve in z and z cubed, off by less than 2e-4 near the middle."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(1.5976) * z + F.lit(0.070566) * z * z * z))


def battery(tokens: DataFrame, word: str = "word") -> DataFrame:
    """Add ``encoding, p_random, p_text``: the combined test of randomness, and the case against ordinary text."""
    w = F.col(word)
    encoding = (
        F.when(w.rlike(r"^[0-9]+$"), "decimal")
        .when(w.rlike(r"^([0-9a-f]+|[0-9A-F]+)$"), "hex")
        .when(w.rlike(r"^(?=.*[2-7])[A-Z2-7]+=*$"), "base32")
        .when(w.rlike(r"^(?=.*[0-9])([a-z0-9]+|[A-Z0-9]+)$"), "base36")
        .otherwise("base64")
    )
    df = tokens.withColumn("encoding", encoding)
    alphabets = {"decimal": "0123456789", "hex": "0123456789abcdef", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "base36": "0123456789abcdefghijklmnopqrstuvwxyz", "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"}
    alphabet, m = F.lit(None).cast("string"), F.lit(None).cast("double")
    for name, letters in alphabets.items():
        alphabet = F.when(F.col("encoding") == name, letters).otherwise(alphabet)
        m = F.when(F.col("encoding") == name, float(len(letters))).otherwise(m)
    plain = F.translate(F.regexp_replace(w, "=+$", ""), "-_", "+/")
    plain = F.when(F.col("encoding").isin("hex", "base36"), F.lower(plain)).otherwise(plain)
    df = df.withColumn("_plain", plain).withColumn("_alphabet", alphabet).withColumn("_m", m)
    df = df.withColumn("_index", F.transform(F.filter(F.split("_plain", ""), lambda c: c != ""), lambda c: F.instr(F.col("_alphabet"), c).cast("double") - 1))
    df = stage(df.withColumn("_index", F.filter("_index", lambda x: x >= 0)).withColumn("_n", F.size("_index").cast("double")), "secrets-index")
    counts = F.transform(F.array_distinct("_index"), lambda s: F.size(F.filter(F.col("_index"), lambda x: x == s)).cast("double"))
    df = df.withColumn("_squares", F.aggregate(counts, F.lit(0.0), lambda a, c: a + c * c))
    # Null below two symbols: null divisors give null, where zeros would end the query.
    tested = F.col("_n") >= 2
    n, m = F.when(tested, F.col("_n")), F.col("_m")
    chi = m / n * F.col("_squares") - n
    df = df.withColumn("_z_chi", (chi - (m - 1)) / F.sqrt(2 * (m - 1) * (1 - 1 / n)))
    steps = F.greatest(F.lit(0), F.size("_index") - 1)
    pairs = F.zip_with(F.slice("_index", 1, steps), F.slice("_index", 2, steps), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    df = df.withColumn("_pairs", pairs).withColumn("_mean", F.aggregate("_index", F.lit(0.0), lambda a, x: a + x) / n)
    runs = F.size(F.filter("_pairs", lambda p: (p["a"] * 2 < m) != (p["b"] * 2 < m))) + 1
    df = df.withColumn("_z_runs", (runs - (n + 1) / 2) / F.sqrt((n - 1) / 4))
    # The tests are written before they are combined: as one plan, each would be repeated many times over.
    mean = F.col("_mean")
    lagged = F.aggregate("_pairs", F.lit(0.0), lambda a, p: a + (p["a"] - mean) * (p["b"] - mean))
    spread = F.aggregate("_index", F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean))
    df = df.withColumn("_z_serial", F.when(spread > 0, (lagged / spread + 1 / n) * F.sqrt(n)).otherwise(F.sqrt(n)))
    df = stage(df, "secrets-tests")
    floor = F.lit(1e-30)
    p = [F.greatest(floor, _tail(F.least(F.lit(20.0), F.col("_z_chi")))), *(F.greatest(floor, F.least(F.lit(1.0), 2 * _tail(F.least(F.lit(20.0), F.abs(F.col(c)))))) for c in ("_z_runs", "_z_serial"))]
    x = -(F.log(p[0]) + F.log(p[1]) + F.log(p[2]))
    df = df.withColumn("_x", x).withColumn("p_random", F.when(tested, F.exp(-F.col("_x")) * (1 + F.col("_x") + F.col("_x") * F.col("_x") / 2)).otherwise(1.0))
    text = F.greatest(F.lit(TEXT_COINCIDENCE), 2 / m)
    coincidence = (F.col("_squares") - n) / (n * (n - 1))
    z = (text - coincidence) / F.sqrt(2 * text * (1 - text) / (n * (n - 1)))
    p_text = F.greatest(F.lit(1e-40), _tail(F.greatest(F.lit(-20.0), F.least(F.lit(20.0), z))))
    return df.withColumn("p_text", F.when(tested, p_text).otherwise(1.0)).drop(*[c for c in df.columns if c.startswith("_")], "_x")


def discoveries(tokens: DataFrame, rate: float = 0.01, random_level: float = 0.001) -> DataFrame:
    """The tokens that are secrets: randomness not rejected, and a discovery within their length band."""
    band = F.lit(0)
    for edge in BANDS:
        band = band + (F.length("word") >= edge).cast("int")
    bin_of = F.least(F.lit(BINS), F.floor(-F.log10("p_text") / BIN)).cast("int")
    binned = tokens.withColumn("_band", band).withColumn("_bin", bin_of)
    histogram = binned.groupBy("_band", "_bin").agg(F.count("*").alias("_n"))
    best = W.partitionBy("_band").orderBy(F.desc("_bin"))
    ranked = histogram.withColumn("_rank", F.sum("_n").over(best)).withColumn("_all", F.sum("_n").over(W.partitionBy("_band")))
    passing = ranked.where(F.pow(F.lit(10.0), -F.col("_bin") * BIN) <= F.lit(rate) * F.col("_rank") / F.col("_all"))
    limits = passing.groupBy("_band").agg(F.min("_bin").alias("_least"))
    # At most one row per band.
    kept = binned.join(F.broadcast(limits), "_band").where((F.col("_bin") >= F.col("_least")) & (F.col("p_random") >= random_level))
    return kept.drop("_band", "_bin", "_least")


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", rate: float = 0.01) -> DataFrame:
    """``key, text_hash, spans``: base spans and discoveries of every document, ordered by start and kind.

    One row per input row; rows of the same id and text are the same document and have the same spans. The result of the
    scan, which holds no text but the matches, is written once to the shared folder.
    """
    scanned = stage(scan(docs.select(key, text), text).select(key, F.xxhash64(key, text).alias("text_hash"), "spans", "tokens"), "secrets-scan")
    tokens = scanned.where(F.size("tokens") > 0).dropDuplicates([key, "text_hash"]).select(F.col("text_hash").alias("hash_"), F.explode("tokens").alias("t"))
    tokens = tokens.select("hash_", F.col("t.start").alias("start"), F.col("t.end").alias("end"), F.col("t.word").alias("word"))
    found = discoveries(stage(battery(tokens), "secrets-battery"), rate)
    extra = found.groupBy("hash_").agg(F.collect_list(F.struct(F.lit(3).alias("kind"), "start", "end", "word")).alias("_extra"))
    joined = scanned.join(extra, F.col("text_hash") == F.col("hash_"), "left")
    every = F.concat("spans", F.coalesce("_extra", F.array().cast("array<struct<kind:int,start:int,end:int,word:string>>")))
    ordered = F.array_sort(F.transform(every, lambda s: F.struct(s["start"], s["kind"], s["end"], s["word"])))
    return joined.select(key, "text_hash", ordered.alias("spans"))


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", mark: str = "<SECRET>", rate: float = 0.01) -> DataFrame:
    """``docs`` with every secret replaced by ``mark``; spans that overlap are replaced together. Null texts stay null.

    Every document stays, whatever it held; columns keep their order.
    """
    found = find(docs, key, text, rate).where(F.size("spans") > 0).dropDuplicates(["text_hash"]).select(F.col("text_hash").alias("_hash"), F.col("spans").alias("_spans"))
    hashed = docs.join(found, F.xxhash64(docs[key], docs[text]) == F.col("_hash"), "left")
    piece = lambda a, s: F.struct(
        F.greatest(a["at"], s["end"]).alias("at"),
        F.when(s["start"] < a["at"], a["out"]).otherwise(F.concat(a["out"], F.substring(F.col(text), a["at"] + 1, s["start"] - a["at"]), F.lit(mark))).alias("out"),
    )
    done = F.aggregate("_spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), piece, lambda a: F.concat(a["out"], F.substring(F.col(text), a["at"] + 1, F.length(text))))
    return hashed.withColumn(text, F.when(F.col("_spans").isNull(), F.col(text)).otherwise(done)).select(*docs.columns)


def marks(spans: Column) -> Column:
    name = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


@query("op7_secrets")
def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document: counts and spans of the base patterns, and all spans."""
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] < 3)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", *(count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:3])), F.sha2(marks(base), 256).alias("base_sha256"), marks(F.col("spans")).alias("spans"))
