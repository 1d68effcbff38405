"""Personal data: patterns, and information-theoretic sanitisation of the
terms that give protected entities away; DataFrame functions only.

Base kinds are patterns with a check each: ``email``, ``ip`` (parts at most
255), ``card`` (16 to 19 digits, Luhn) and ``phone`` (8 to 15 digits).  They
are leftmost and without overlap within a kind; a match that fails its check
is dropped.  The patterns below find the same matches as the plain ones but
start only where a run of their characters starts, so that long runs are read
once.

A protected entity is a base match by kind and normalised value.  Its context
is the ``window`` words on either side, up to the next base match and at most
``REACH`` characters.  Over the whole corpus, with N rows, n(e) of them
holding e, n(t) holding term t, and c(e, t) holding t in a context of e:

* the information of e is log2(N / n(e)),
* what t tells about e is their pointwise mutual information,
  log2(c(e, t) N / (n(e) n(t))),
* and what it leaves open is the difference, log2(n(t) / c(e, t)).

A term discloses e if it tells at least ``share`` of e's information and
leaves at most ``open_bits`` bits, seen in ``contexts`` different contexts at
least (copies of one passage are one context).  It is removed if it leaves at
most ``remove_bits``, and generalised to its class otherwise.  Such terms
become spans wherever they occur, outside base matches.

Scale.  Base spans are a projection.  Words are counted with partial sums per
task and only where they stand in some context often enough; the terms that
disclose come back to the texts by joins on the term and then on the text's
digest, so a text copied a million times is one row there.  Join sides are
sized by Spark from written tables.  Nothing reaches the driver but the
number of rows.

Edge cases: a null text is an empty one, without spans; repeated rows count as
often as they occur and give repeated rows; very long texts take time near
their length; an entity in every row has no information and nothing discloses
it; an empty table gives an empty one.  Columns beside the text are carried
under their own names, whatever they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourglass.llm import spans as S
from hourglass.llm.common import saved, table

EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
IP_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
CARD = r"[0-9](?:[\x20-]?[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
WORD = r"[\p{L}\p{M}\p{N}_]{2,}+"

BASE = ["email", "ip", "card", "phone"]
KINDS = [*BASE, "generalise", "remove"]
MARKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}
WINDOW, REACH, CONTEXTS = 8, 200, 3
SHARE, OPEN_BITS, REMOVE_BITS = 0.9, 1.0, 0.15

PAIR = "\n"  # between entity and term, in neither of them

_ITEM = "struct<start:int,end:int,kind_no:int,value:string>"
_EMPTY = f"cast(array() as array<{_ITEM}>)"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes: every second digit from the right, doubled, less 9 beyond 9."""
    def step(total: Column, i: Column) -> Column:
        digit = F.ascii(F.substring(F.reverse(digits), i, F.lit(1))) - 48
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), step) % 10 == 0


#: kind: a character without which there is no match, the pattern, the check, the value that names the entity
_RULES = {
    "email": ("@", EMAIL, lambda v: F.lit(True), F.lower),
    "ip": (".", IP, lambda v: v.rlike(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$"), lambda v: v),
    "card": (None, CARD, lambda v: (F.char_length(_digits(v)) <= 19) & luhn(_digits(v)), _digits),
    "phone": ("+", PHONE, lambda v: F.char_length(_digits(v)).between(8, 15), _digits),
}


def base_spans(text: Column) -> Column:
    """array of (start, end, kind_no, value) of all base kinds, by start; ``text`` is not null."""
    def of(kind: str) -> Column:
        sign, pattern, check, name = _RULES[kind]
        span = lambda m: F.struct(m["start"].alias("start"), S.end_of(m).alias("end"), F.lit(KINDS.index(kind)).alias("kind_no"),
                                  name(m["value"]).alias("value"))
        found = F.transform(F.filter(S.matches(text, pattern), lambda m: check(m["value"])), span).cast(f"array<{_ITEM}>")
        return found if sign is None else F.when(F.contains(text, F.lit(sign)), found).otherwise(F.expr(_EMPTY))

    return F.array_sort(F.concat(*map(of, BASE)))


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def _mentions(work: DataFrame, window: int) -> DataFrame:
    """Per row with base matches: ``mentions``, an array of (entity, terms of
    its context), and ``pairs`` and ``entities``, the different ones of the row."""
    entity = lambda s: F.concat(F.get(F.array(*map(F.lit, BASE)), s["kind_no"]), F.lit(":"), s["value"])
    some = work.where(F.size("pii_base") > 0).withColumn("pii_runs", S.runs(F.col("pii_base"), entity))
    some = some.withColumn("pii_gaps", S.gaps(F.col("pii_text"), F.col("pii_runs")))

    # Whole words only: where a gap goes on beyond the reach, the word at the cut does not count.
    def beside(gap: Column, last: bool) -> Column:
        cut = F.char_length(gap) > REACH
        seen = F.when(cut, (F.right if last else F.left)(gap, F.lit(REACH))).otherwise(gap)
        # The words nearest to the entity first.
        order = F.reverse if last else (lambda w: w)
        return S.let(order(words(seen)), lambda w: F.slice(w, 1, F.least(F.lit(window), F.greatest(F.size(w) - cut.cast("int"), F.lit(0)))))

    near = F.transform(F.sequence(F.lit(0), F.size("pii_runs") - 1), lambda k: F.struct(
        F.get("pii_runs", k)["kind"].alias("entity"),
        F.array_distinct(F.concat(beside(F.get("pii_gaps", k), True), beside(F.get("pii_gaps", k + 1), False))).alias("terms")))
    found = some.select(near.alias("mentions"))
    pairs = F.flatten(F.transform("mentions", lambda m: F.transform(m["terms"], lambda t: F.concat(m["entity"], F.lit(PAIR), t))))
    return found.select("mentions", F.array_distinct(pairs).alias("pairs"),
                        F.array_distinct(F.flatten(F.transform("mentions", lambda m: m["terms"]))).alias("terms"),
                        F.array_distinct(F.transform("mentions", lambda m: m["entity"])).alias("entities"))


def disclosing(work: DataFrame, *, window: int = WINDOW, contexts: int = CONTEXTS, share: float = SHARE,
               open_bits: float = OPEN_BITS, remove_bits: float = REMOVE_BITS) -> DataFrame:
    """term, kind (generalise or remove), the entity it discloses most, the share of its information and the bits left open."""
    rows = work.count()
    near = saved(_mentions(work, window), "mentions")
    part = lambda k: F.split("pair", PAIR).getItem(k)
    held = near.select(F.explode("pairs").alias("pair")).select(part(0).alias("entity"), part(1).alias("term"), F.lit(1).alias("row"),
                                                                 F.lit(None).cast("long").alias("context"))
    seen = near.select(F.explode("mentions").alias("m")).select("m.entity", F.explode("m.terms").alias("term"), F.lit(0).alias("row"),
                                                                 F.xxhash64("m.terms").alias("context"))
    pairs = held.unionByName(seen).groupBy("entity", "term").agg(F.sum("row").alias("together"), F.count_distinct("context").alias("contexts"))
    # A term stands in at least as many rows as it stands beside any entity in: what is too common there is too common anyway.
    near_rows = near.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("near_rows"))
    pairs = pairs.where(F.col("contexts") >= contexts).join(near_rows, "term")
    pairs = saved(pairs.where(F.log2(F.col("near_rows") / F.col("together")) <= open_bits).drop("near_rows"), "pairs")
    entities = near.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("entity_rows"))
    asked = saved(pairs.select("term").distinct(), "asked")
    each = work.select(F.explode(F.array_distinct(words(F.col("pii_text")))).alias("term"))
    terms = each.join(asked, "term", "left_semi").groupBy("term").agg(F.count("*").alias("term_rows"))

    told = pairs.join(entities, "entity").join(terms, "term")
    whole = F.log2(F.lit(float(max(rows, 1))) / F.col("entity_rows"))
    told = told.withColumn("open", F.log2(F.col("term_rows") / F.col("together"))).withColumn("share", F.when(whole > 0, 1 - F.col("open") / whole))
    told = told.where((F.col("share") >= share) & (F.col("open") <= open_bits))
    best = told.groupBy("term").agg(F.min(F.struct("open", (-F.col("share")).alias("less"), "entity")).alias("best"))
    kind = F.when(F.col("best.open") <= remove_bits, "remove").otherwise("generalise")
    return best.select("term", kind.alias("kind"), "best.entity", (-F.col("best.less")).alias("share"), F.col("best.open").alias("open"))


def _work(docs: DataFrame, text_col: str) -> tuple[DataFrame, list[Column]]:
    """The text and all columns under names of our own, with the base spans; and the columns under their old names."""
    given = [F.col(f"`{c}`").alias(f"pii_own_{k}") for k, c in enumerate(docs.columns)]
    work = docs.select(*given, F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("pii_text"))
    return work.withColumn("pii_base", base_spans(F.col("pii_text"))), [F.col(f"pii_own_{k}").alias(c) for k, c in enumerate(docs.columns)]


def _scanned(docs: DataFrame, text_col: str, how: dict) -> tuple[DataFrame, list[Column]]:
    """The work columns and ``pii_spans``: all spans by start."""
    work, own = _work(docs, text_col)
    found = saved(disclosing(work, **how), "disclosing")
    key = F.md5(F.col("pii_text").cast("binary"))
    each = work.select(key.alias("pii_key"), F.explode(F.array_distinct(words(F.col("pii_text")))).alias("term"))
    hits = each.join(found.select("term", "kind"), "term").groupBy("pii_key", "term", "kind").agg(F.lit(1).alias("one"))
    hits = hits.groupBy("pii_key").agg(F.collect_list(F.when(F.col("kind") == "remove", F.col("term"))).alias("pii_remove"),
                                       F.collect_list(F.when(F.col("kind") != "remove", F.col("term"))).alias("pii_generalise"))
    work = work.withColumn("pii_key", key).join(saved(hits, "hits"), "pii_key", "left")

    def span(m: Column) -> Column:
        term = F.lower(m["value"])
        kind = F.when(F.array_contains("pii_remove", term), KINDS.index("remove")).when(
            F.array_contains("pii_generalise", term), KINDS.index("generalise"))
        return F.struct(m["start"].alias("start"), S.end_of(m).alias("end"), kind.alias("kind_no"), m["value"].alias("value"))

    added = F.filter(F.transform(S.matches(F.col("pii_text"), WORD), span), lambda s: s["kind_no"].isNotNull()).cast(f"array<{_ITEM}>")
    free = F.when(F.col("pii_remove").isNotNull(), S.beside(F.col("pii_base"), added, False, _ITEM)).otherwise(F.expr(_EMPTY))
    return work.withColumn("pii_spans", F.array_sort(F.concat("pii_base", free))), own


def scan(docs: DataFrame, *, text_col: str = "text", spans_col: str = "spans", **how) -> DataFrame:
    """``docs`` with ``spans_col``: array of (start, end, kind, value) by kind
    and then by start; the value of a base match is its entity's, normalised.  ``how``: see ``disclosing``."""
    work, own = _scanned(docs, text_col, how)
    ordered = F.array_sort(F.transform("pii_spans", lambda s: F.struct(s["kind_no"].alias("kind_no"), s["start"].alias("start"),
                                                                       s["end"].alias("end"), s["value"].alias("value"))))
    named = F.transform(ordered, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                    F.get(F.array(*map(F.lit, KINDS)), s["kind_no"]).alias("kind"), s["value"].alias("value")))
    return work.select(*own, named.alias(spans_col))


def sanitise(docs: DataFrame, *, text_col: str = "text", **how) -> DataFrame:
    """``docs`` with each run of overlapping spans replaced: base kinds by
    their mark, generalised terms by their class, removed terms by nothing."""
    work, own = _scanned(docs, text_col, how)

    def mark(s: Column) -> Column:
        by_class = F.when(s["value"].rlike(r"^\p{N}+$"), "[NUMBER]").when(s["value"].rlike(r"^\p{Lu}"), "[NAME]").otherwise("[WORD]")
        base = F.get(F.array(*(F.lit(MARKS[k]) for k in BASE)), s["kind_no"])
        return F.when(s["kind_no"] < len(BASE), base).when(s["kind_no"] == KINDS.index("generalise"), by_class).otherwise(F.lit(""))

    found = S.runs(F.col("pii_spans"), mark)
    clean = F.when(F.size("pii_spans") > 0, S.replaced(F.col("pii_text"), found)).otherwise(own[docs.columns.index(text_col)])
    return work.select(*(clean.alias(c) if c == text_col else old for c, old in zip(docs.columns, own)))


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op11_pii(spark, sf_dir):
    """Per document: base matches by kind, their digest, and all spans."""
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(BASE))
    return found.select("doc_id", *map(n, BASE), F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))
