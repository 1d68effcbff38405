"""Secret scans in DataFrame functions only.

Base kinds are regular expressions, leftmost and without overlap for each
kind: ``assign`` (a name such as password, a separator, a value of eight or
more characters), ``access`` (AKIA keys of 16 or more characters) and ``hex``
(runs of 32 or more).  The method adds ``entropy_hex`` and
``entropy_base64``: runs of ``window`` or more token characters are candidate
strings; over each one a window slides, whose character counts are updated by
one character in and one out, and with them the sum of count x log2(count)
that gives the Shannon entropy.  The stretch from the first to the last window
at or above the class's threshold is a span, unless the candidate matches the
allow-list or the stretch meets a base span.

That rule loses what stands beside a base span or a placeholder word, so the
query and the pipeline scan with ``whole``: a span is left out only if one base
span covers it, and placeholder words cut a run into candidates of their own
instead of excusing all of it.

Offsets are code points, end exclusive.  They come from the lengths of the
pieces between matches (see ``spans``), so a text is searched a second time only
where something matches, and time stays near its length and its matches.

Everything is a projection: no shuffle, and a row's memory follows its text.

Edge cases: a null text is an empty one, without spans; repeated rows give
repeated rows; an empty table gives an empty one; only the id and text columns
are read (``redact`` keeps all columns as they are).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.llm import spans as S
from hourglass.llm.common import table

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# Runs with their least length: the same matches as the whole runs, of which shorter ones are dropped.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
ASSIGN_LENGTH = 8

WINDOW = 20
ALPHABETS = {"entropy_hex": ("0123456789abcdef", 3.0),
             "entropy_base64": ("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-", 3.9)}
KINDS = ["assign", "access", "hex", *ALPHABETS]
# Candidates that are not secrets: numbers, words and paths without digits, placeholders, plain sequences.
ALLOW = [r"^[0-9_=/+-]+$", r"^[A-Za-z/_=+-]+$", r"(?i)example|placeholder|changeme|your[_-]|x{6,}",
         r"(?i)0123456789|abcdefghij", r"^[=/_+-]*[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$"]
# With ``whole``: words that are blanked, character by character, and what excuses a candidate between them.
PLACEHOLDERS = ["example", "placeholder", "changeme", "your[_-]", "x{6}", "0123456789", "abcdefghij"]
ALLOW_WHOLE = [a for a in ALLOW if a.startswith("^")]
MARK = "[SECRET]"

_SPAN = "struct<start:int,kind_no:int,end:int,kind:string>"
_SPANS = f"array<{_SPAN}>"


def _no_spans() -> Column:
    return F.expr(f"cast(array() as {_SPANS})")


def _span(kind: str, start: Column, end: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), F.lit(KINDS.index(kind)).alias("kind_no"),
                    end.cast("int").alias("end"), F.lit(kind).alias("kind"))


def _spans(kind: str, found: Column) -> Column:
    return F.transform(found, lambda x: _span(kind, x["start"], S.end_of(x))).cast(_SPANS)


def _entropy_span(kind: str, x: Column, window: int) -> Column:
    """The candidate's span, or null: one fold over its characters."""
    alphabet, least = ALPHABETS[kind]
    value = F.lower(x["value"]) if kind == "entropy_hex" else x["value"]
    codes = F.transform(F.regexp_extract_all(value, F.lit("."), F.lit(0)), lambda c: F.instr(F.lit(alphabet), c) - 1)
    log = lambda n: n * F.log2(F.greatest(n, F.lit(1)))
    zero = F.struct(F.array_repeat(F.lit(0), len(alphabet)).alias("counts"), F.lit(0.0).cast("double").alias("sum"),
                    F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"))

    def step(codes: Column, acc: Column, i: Column) -> Column:
        into, out = F.get(codes, i), F.when(i >= window, F.get(codes, i - window))
        n_in = F.get(acc["counts"], into)
        n_out = F.get(acc["counts"], out) + F.when(into == out, 1).otherwise(0)
        total = acc["sum"] - log(n_in) + log(n_in + 1) + F.coalesce(log(n_out - 1) - log(n_out), F.lit(0.0))
        hot = (i >= window - 1) & (F.log2(F.lit(float(window))) - total / window >= least)
        counts = F.transform(acc["counts"], lambda n, k: n + F.when(k == into, 1).otherwise(0) - F.when(k == out, 1).otherwise(0))
        return F.struct(counts.alias("counts"), total.alias("sum"),
                        F.coalesce(acc["first"], F.when(hot, i - window + 1)).alias("first"),
                        F.when(hot, i + 1).otherwise(acc["last"]).alias("last"))

    def fold(codes: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), zero, lambda acc, i: step(codes, acc, i),
                           lambda acc: F.when(acc["first"].isNotNull(), _span(kind, x["start"] + acc["first"], x["start"] + acc["last"])))

    return S.let(codes, fold)


def scan(docs: DataFrame, *, text_col: str = "text", window: int = WINDOW, allow: list[str] | None = None,
         whole: bool = False) -> DataFrame:
    """``docs`` with ``secret_spans``: array of (start, kind_no, end, kind),
    by start and then by kind."""
    df = docs.withColumn("scan_text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    text = F.col("scan_text")
    assigned = F.filter(S.matches(text, ASSIGN, 2), lambda x: F.char_length(x["part"]) >= ASSIGN_LENGTH)
    base = [_spans(kind, found) for kind, found in zip(KINDS, (assigned, S.matches(text, ACCESS), S.matches(text, HEX)))]
    df = df.withColumn("base", F.concat(*base))

    if whole:
        for word, length in zip(PLACEHOLDERS, (7, 11, 8, 5, 6, 10, 10)):
            df = df.withColumn("scan_text", F.regexp_replace("scan_text", f"(?i){word}", " " * length))
    df = df.withColumn("candidates", S.matches(text, rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{window},}}"))
    allowed = "|".join(f"(?:{a})" for a in ((ALLOW_WHOLE if whole else ALLOW) if allow is None else allow)) or r"(?!)"
    df = df.withColumn("candidates", F.filter("candidates", lambda x: ~x["value"].rlike(allowed)))
    is_hex = lambda x: x["value"].rlike("^[0-9a-fA-F]+$")
    added = F.transform("candidates", lambda x: F.when(is_hex(x), _entropy_span("entropy_hex", x, window))
                        .otherwise(_entropy_span("entropy_base64", x, window)))
    added = F.filter(added, lambda s: s.isNotNull()).cast(_SPANS)
    df = df.withColumn("added", F.when(F.size("candidates") > 0, S.beside(F.col("base"), added, whole, _SPAN)))
    spans = F.array_sort(F.concat("base", F.coalesce("added", _no_spans())))
    return df.withColumn("secret_spans", spans).drop("scan_text", "base", "candidates", "added")


def redact(docs: DataFrame, *, text_col: str = "text", mark: str = MARK, whole: bool = False) -> DataFrame:
    """``docs`` with each maximal run of overlapping spans in ``text_col`` replaced by ``mark``."""
    df = scan(docs, text_col=text_col, whole=whole)

    clean = S.replaced(F.col(text_col), S.runs(F.col("secret_spans"), lambda _: F.lit(mark)))
    clean = F.when(F.size("secret_spans") > 0, clean).otherwise(F.col(text_col))
    return df.withColumn(text_col, clean).select(*docs.columns)


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op8_secret_scan(spark, sf_dir):
    """Per document: base spans by kind, their digest, and all spans."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), whole=True)
    n = lambda kind: F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("secret_spans", lambda s: s["kind_no"] < 3)
    return found.select("doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
                        F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("secret_spans")).alias("spans"))
