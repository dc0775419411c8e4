"""Personal data: fixed patterns, and terms that disclose the found entities.

Base spans are e-mail addresses, IP addresses, card numbers and phone numbers. On top of them the
corpus tells which other terms give an entity away. Over all documents, an entity c has information
content IC(c) = -ln p(c), and a term t within REACH lines of it carries PMI(c; t) = ln p(c | t) / p(c) of it.
A term discloses c when it says at least a share `disclosure` of that information and leaves at most
`residual` of it unknown (ln 2: one bit): PMI(c; t) >= max(disclosure * IC(c), IC(c) - residual). For p(c | t)
stands the lower end of its Wilson interval of one standard error, where k different texts have both and
a share r of the documents with t has c: k of k / r trials. So the bar does not move with the size of the
corpus. Copies of a text are one piece of evidence. A word of one text only has the lower end 1/2 and just
discloses an entity that stands in no other text either: nothing shows it to be harmless, so it goes, chance
neighbours included. If the entity stands elsewhere without the word, two texts are needed. `least_texts` = 2
keeps all words of one text. Terms are
runs of letters, marks and digits of any length. Disclosing terms are generalised (a capitalised word
becomes [Name]) or removed wherever they stand in any document, except inside base spans; base spans
become [EMAIL], [IP], ...

Only Spark SQL functions are used. No pattern can match across a line break, so base spans are
looked up line by line. Positions come from running sums over the text between matches, one row per
match; putting the text together again copies what is finished for each span.

Defined cases: a null text counts as empty; rows equal in doc_id and text are treated alike; a null
doc_id is a key like others. Other columns pass through; those named like an output column are
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wearline.session import stage, stage_counted

KINDS = ["email", "ip", "card", "phone"]
_LOCAL, _PART = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]+"
# The same leftmost matches as the plain patterns. A run of local-part characters (or digits) is
# tried from its start or from the end of the match before (\G) only: a start inside the run would
# have matched one place earlier. A card match is a whole run of digits with single separators, so
# runs of other lengths, which the length rule drops, are not matched in the first place.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_PART}(?:\.{_PART})+",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
MUST_HOLD = {"email": "@", "ip": ".", "card": "", "phone": "+"}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
OUTPUT = [*(f"n_{k}" for k in KINDS), "n_terms", "base", "spans", "sanitised"]

DISCLOSURE = 0.5
RESIDUAL = 0.6931471805599453
LEAST_TEXTS = 1
REACH = 2
# Terms whose 64-bit hashes may be broadcast.
BROADCAST_TERMS = 1 << 20
TERM = r"\p{L}\p{M}\p{N}"


def luhn(digits: Column) -> Column:
    """True where a string of digits passes the Luhn test."""
    worth = lambda i: F.substring(F.reverse(digits), i, F.lit(1)).cast("int") * (2 - i % 2)
    total = F.aggregate(
        F.transform(F.sequence(F.lit(1), F.length(digits)), worth),
        F.lit(0),
        lambda acc, x: acc + F.when(x > 9, x - 9).otherwise(x),
    )
    return total % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    return (
        F.when(kind == 1, match.rlike(rf"^{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}$"))
        .when(kind == 2, F.length(digits).between(12, 19) & luhn(digits))
        .when(kind == 3, F.length(digits).between(9, 15))
        .otherwise(True)
    )


def documents_with_matches(docs: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Keys, text and the matches of each kind, for documents that have any."""
    found = docs.select(
        *keys,
        text,
        *(
            F.when(F.contains(text, F.lit(MUST_HOLD[k])), F.regexp_extract_all(text, F.lit(PATTERNS[k]), F.lit(0))).alias(f"__{k}")
            for k in KINDS
        ),
    )
    hit = F.lit(False)
    for k in KINDS:
        hit = hit | F.coalesce(F.size(f"__{k}") > 0, F.lit(False))
    return found.where(hit)


def base_spans(found: DataFrame, keys: list[str], text: str) -> DataFrame:
    """One row per base span: keys, start, end (exclusive, code points), kind (place in KINDS), value."""
    kinds = F.array(
        *(
            F.struct(F.lit(i).alias("kind"), F.col(f"__{k}").alias("matches"), F.split(text, PATTERNS[k], -1).alias("gaps"))
            for i, k in enumerate(KINDS)
        )
    )
    # A row with many matches becomes one row per match and kind; the running sum gives the places.
    pieces = (
        found.select(*keys, F.inline(kinds))
        .where("size(matches) > 0")
        .select(*keys, "kind", F.posexplode(F.arrays_zip("gaps", "matches")).alias("i", "piece"))
        .where("piece.matches is not null")
        .select(*keys, "kind", "i", F.col("piece.matches").alias("value"), F.length("piece.gaps").alias("gap"))
    )
    until = Window.partitionBy(*keys, "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = pieces.withColumn("end", F.sum(F.col("gap") + F.length("value")).over(until))
    return placed.where(_valid(F.col("kind"), F.col("value"))).select(
        *keys, (F.col("end") - F.length("value")).alias("start"), "end", "kind", "value"
    )


def words(text: Column) -> Column:
    """Distinct lower-case terms."""
    return F.filter(F.array_distinct(F.split(F.lower(text), f"[^{TERM}]+")), lambda w: F.length(w) > 0)


def _entity_lines(found: DataFrame, spans: DataFrame, keys: list[str]) -> DataFrame:
    """Lines that hold a base span: keys, times, entities, the words in and near the line."""
    held = spans.groupBy(*keys).agg(F.collect_list(F.struct("start", "end", "kind", "value")).alias("held"))
    lines = found.join(held, keys).select(*keys, "times", "held", F.posexplode(F.split("__text", "\n", -1)).alias("no", "line"))
    before = Window.partitionBy(*keys).orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumn("offset", F.coalesce(F.sum(F.length("line") + 1).over(before), F.lit(0)))
    inside = F.filter("held", lambda s: (s["start"] >= F.col("offset")) & (s["end"] <= F.col("offset") + F.length("line")))
    lines = lines.withColumn("held", inside)
    rest = F.aggregate("held", F.col("line"), lambda acc, s: F.replace(acc, s["value"], F.lit(" ")))
    # A line's neighbours go in without their own base spans.
    near = Window.partitionBy(*keys).orderBy("no").rowsBetween(-REACH, REACH)
    lines = lines.withColumn("rest", rest).withColumn("near", F.array_join(F.collect_list("rest").over(near), "\n")).where(F.size("held") > 0)
    return lines.select(
        *keys,
        "times",
        F.array_distinct(F.transform("held", lambda s: F.concat_ws(":", s["kind"], F.lower(s["value"])))).alias("entities"),
        words(F.col("near")).alias("words"),
    )


def wilson_low(hits: Column, trials: Column) -> Column:
    """Lower end of the Wilson interval of one standard error for `hits` of `trials`."""
    share = F.least(hits / trials, F.lit(1.0))
    return (share + 1 / (2 * trials) - F.sqrt(share * (1 - share) / trials + 1 / (4 * trials * trials))) / (1 + 1 / trials)


def disclosing_terms(keyed: DataFrame, lines: DataFrame, disclosure: float, residual: float, least_texts: int) -> DataFrame:
    """(entity, word) pairs whose word discloses the entity."""
    by_document = ["__id", "__hash"]
    pairs = (
        lines.select(*by_document, "times", F.explode("entities").alias("entity"), "words")
        .select(*by_document, "times", "entity", F.explode("words").alias("word"))
        .groupBy("entity", "word", *by_document)
        .agg(F.max("times").alias("n"))
        .groupBy("entity", "word", "__hash")
        .agg(F.sum("n").alias("n"))
        .groupBy("entity", "word")
        .agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("n_pair"))
        .where(F.col("texts") >= least_texts)
    )
    pairs = stage(pairs, "pii-pairs")
    entities = (
        lines.select(*by_document, "times", F.explode("entities").alias("entity"))
        .groupBy("entity", *by_document)
        .agg(F.max("times").alias("n"))
        .groupBy("entity")
        .agg(F.sum("n").alias("n_entity"))
    )
    total = keyed.count() or 1
    counts = keyed.select(F.explode(words(F.col("__text"))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n_word"))
    total = F.lit(float(total))
    joined = pairs.join(entities, "entity").join(counts, "word")
    information = F.ln(total / F.col("n_entity"))
    texts = F.col("texts").cast("double")
    shared = F.ln(wilson_low(texts, texts * F.col("n_word") / F.col("n_pair"))) + information
    needed = F.greatest(disclosure * information, information - residual)
    # An entity in every document has no information to disclose.
    return joined.where((information > 0) & (shared >= needed - 1e-9) & ((F.col("texts") > 1) | (F.col("n_pair") == F.col("n_entity")))).select("entity", "word")


def term_spans(keyed: DataFrame, spans: DataFrame, terms: DataFrame, keys: list[str]) -> DataFrame:
    """Places of disclosing terms in all documents, outside base spans."""
    known, count = stage_counted(terms.select("word").distinct(), "pii-terms")
    boundary = f"(?<=[{TERM}])(?=[^{TERM}])|(?<=[^{TERM}])(?=[{TERM}])"
    if count <= BROADCAST_TERMS:
        # Their hashes leave out all other words before any are shuffled. A document's remaining words stand
        # in one task, which puts them together again: its text is shuffled once, and only if it has any.
        hashed = F.xxhash64("word").alias("hashed")
        held = keyed.select(*keys, "__text", F.explode(words(F.col("__text"))).alias("word")).select("*", hashed)
        held = held.join(F.broadcast(known.select(hashed).distinct()), "hashed", "left_semi")
        texts = held.groupBy(*keys).agg(F.first("__text").alias("__text"), F.collect_set("word").alias("flagged"))
    else:
        # Beyond, the plain join does; the exploded words carry no text, which is fetched for documents with a flagged word.
        held = keyed.select(*keys, F.explode(words(F.col("__text"))).alias("word")).join(known, "word")
        flagged = stage(held.groupBy(*keys).agg(F.collect_set("word").alias("flagged")), "pii-flagged")
        texts = keyed.join(flagged, keys).groupBy(*keys).agg(F.first("__text").alias("__text"), F.first("flagged").alias("flagged"))
    parts = texts.select(*keys, "flagged", F.posexplode(F.split("__text", boundary, -1)).alias("i", "part")).select(
        *keys, "i", "part", F.array_contains("flagged", F.lower("part")).alias("hit")
    )
    until = Window.partitionBy(*keys).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("end", F.sum(F.length("part")).over(until)).where("hit")
    if count <= BROADCAST_TERMS:  # two words can have one hash
        parts = parts.join(known, F.lower("part") == F.col("word"), "left_semi")
    found = parts.select(*keys, (F.col("end") - F.length("part")).alias("start"), "end", F.lit(len(KINDS)).alias("kind"), F.col("part").alias("value"))
    # A term inside a base span goes with it.
    every = found.unionByName(spans.select(*keys, "start", "end", "kind", "value"))
    ahead = Window.partitionBy(*keys).orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    covered = F.max(F.when(F.col("kind") < len(KINDS), F.col("end"))).over(ahead)
    return every.withColumn("covered", covered).where(f"kind = {len(KINDS)} and (covered is null or end > covered)").drop("covered")


def sanitise(
    docs: DataFrame, text: str = "text", key: str = "doc_id", disclosure: float = DISCLOSURE, residual: float = RESIDUAL, least_texts: int = LEAST_TEXTS
) -> DataFrame:
    """`docs` with counts per kind, base and spans (kind:start:end, comma-joined) and the sanitised text."""
    docs = docs.drop(*OUTPUT)
    keys = ["__id", "__hash"]
    whole = F.coalesce(F.col(text), F.lit(""))
    keyed = docs.select(
        F.coalesce(F.col(key).cast("string"), F.lit("null")).alias("__id"), F.xxhash64(whole).alias("__hash"), whole.alias("__text")
    )
    # The documents with matches are written once, so that whole texts are never shuffled; rows equal
    # in key and text would find every span twice, and are counted instead.
    matches = [f"__{k}" for k in KINDS]
    found = documents_with_matches(keyed, keys, "__text").groupBy(*keys)
    found = stage(found.agg(*(F.first(c).alias(c) for c in ["__text", *matches]), F.count(F.lit(1)).alias("times")), "pii-documents")
    spans = stage(base_spans(found, keys, "__text"), "pii-spans")
    lines = stage(_entity_lines(found, spans, keys), "pii-lines")
    terms = disclosing_terms(keyed, lines, disclosure, residual, least_texts)
    names = F.array(*(F.lit(k) for k in [*KINDS, "term"]))
    every = spans.unionByName(term_spans(keyed, spans, terms, keys)).withColumn("name", F.get(names, F.col("kind")))
    entry = F.concat_ws(":", "name", "start", "end")
    collected = every.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end", entry.alias("entry"), "value"))).alias("__found")
    )
    # Join on columns, not expressions, so that the text is not needed for the join itself.
    named = docs.withColumns({"__id": F.coalesce(F.col(key).cast("string"), F.lit("null")), "__hash": F.xxhash64(whole)})
    out = named.join(collected, keys, "left")
    found = F.coalesce("__found", F.array().cast("array<struct<start:bigint,kind:int,end:bigint,entry:string,value:string>>"))
    out = out.withColumn("__found", found)
    count = lambda i: F.size(F.filter("__found", lambda s: s["kind"] == i)).cast("long")
    joined = lambda entries: F.array_join(F.transform(entries, lambda s: s["entry"]), ",")
    # The text from the last span's end on is appended after the fold; overlapping spans are cut once.
    generalised = lambda s: (
        F.when(s["kind"] < len(KINDS), F.concat(F.lit("["), F.upper(F.get(names, s["kind"])), F.lit("]")))
        .when(F.substring(s["value"], 1, 1) != F.lower(F.substring(s["value"], 1, 1)), F.lit("[Name]"))
        .otherwise(F.lit(""))
    )
    start = F.struct(F.lit("").alias("text"), F.lit(0).cast("bigint").alias("at"))
    folded = F.aggregate(
        "__found",
        start,
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct(
                F.concat(acc["text"], F.substring(whole, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), generalised(s)).alias("text"),
                s["end"].alias("at"),
            ),
        ).otherwise(F.struct(acc["text"].alias("text"), F.greatest(acc["at"], s["end"]).alias("at"))),
        lambda acc: F.concat(acc["text"], F.substring(whole, (acc["at"] + 1).cast("int"), F.length(whole))),
    )
    return out.select(
        *docs.columns,
        *(count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)),
        count(len(KINDS)).alias("n_terms"),
        joined(F.filter("__found", lambda s: s["kind"] < len(KINDS))).alias("base"),
        joined("__found").alias("spans"),
        F.when(F.size("__found") > 0, folded).otherwise(whole).alias("sanitised"),
    )


