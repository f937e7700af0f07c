"""Personal data: identifiers by pattern, and the terms of a text that would reveal them.

Four kinds of identifiers (the protected entities) are found by pattern and check.  How strongly a term
reveals an entity is then estimated from all documents: the pointwise mutual information of the two,
log2(n(term, entity) n / (n(term) n(entity))), against the information of the entity itself,
log2(n / n(entity)).  A term that supplies at least ``disclosure`` of that information, in at least
``support`` documents, is a span too in every document that has both; ``sanitise`` generalises identifiers
to their kind and removes such terms.  Terms are the runs of letters, marks and digits outside the checked
identifiers, of any length but for short words of lower-case ASCII letters (``min_letters``).

Everything is built from DataFrame functions.  Positions come from marking the matches in the text with
two private-use characters (those of the text itself are replaced first, one for one) and adding up the
lengths between the marks.  The patterns are those of the definition, with possessive repeats and, where a
match can only start a run of characters, a look-behind, so that no text takes more than linear time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plycask.llm.scratch import Scratch

_OPEN, _CLOSE, _OTHER = "\ue000", "\ue001", "\ue002"
_IN_TERM = r"\p{L}\p{M}\p{N}"
TERM = "term"

#: Kind and pattern; \G lets a match start where the one before it ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
KINDS = list(PATTERNS)


@dataclass(frozen=True)
class Disclosure:
    """support: documents that must have a term and an entity both; disclosure: share of the entity's information that the term gives; min_letters: of a term of lower-case ASCII letters alone."""

    support: int = 3
    disclosure: float = 0.9
    min_letters: int = 3


def _no_spans() -> Column:
    return F.array().cast("array<struct<start:int,value:string>>")


def _added_up(parts: Column) -> Column:
    """(start, value) of marked matches from the parts between the opening marks."""
    def step(done: Column, part: Column) -> Column:
        match = F.struct(done["at"].alias("start"), F.substring_index(part, _CLOSE, 1).alias("value"))
        return F.struct((done["at"] + F.length(part) - 1).alias("at"), F.concat(done["found"], F.array(match)).alias("found"))

    start = F.struct(F.length(parts[0]).alias("at"), _no_spans().alias("found"))
    return F.aggregate(F.slice(parts, 2, F.size(parts)), start, step, lambda done: done["found"])


def find(text: Column, pattern: str) -> Column:
    """All matches, leftmost first and not overlapping, as an array of (start, value); starts count code points.  text must be free of the marks."""
    # Within transform, the parts have a name and are made once.
    cut = F.array(F.split(F.regexp_replace(text, pattern, f"{_OPEN}$0{_CLOSE}"), _OPEN))
    return F.transform(cut, lambda parts: F.when(F.size(parts) > 1, _added_up(parts)).otherwise(_no_spans()))[0]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit is right; for 13 to 19 digits."""
    backwards = F.reverse(digits)

    def weighted(i: Column) -> Column:
        digit = F.substring(backwards, i + 1, F.lit(1)).cast("int")
        double = digit * 2
        return F.when(i % 2 == 0, digit).when(double > 9, double - 9).otherwise(double)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda total, i: total + weighted(i)) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    """The check that a match of a kind must pass."""
    if kind == "ip":
        short = lambda part: F.regexp_replace(part, "^0+(?=[0-9])", "")
        return F.forall(F.split(value, r"\."), lambda part: F.when(F.length(short(part)) > 3, False).otherwise(short(part).cast("int") <= 255))
    digits = _digits(value)
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _checked(kind: str, text: Column) -> Column:
    return F.filter(find(text, PATTERNS[kind]), lambda span: _holds(kind, span["value"]))


def _entities(kind: str) -> Column:
    """One name for all writings of an entity, for each span."""
    name = F.lower if kind in ("email", "ip") else _digits
    return F.transform(F.col(kind), lambda span: F.concat(F.lit(f"{kind}:"), name(span["value"])))


def _listed(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda span: F.concat_ws(":", F.lit(kind), span["start"], span["start"] + F.length(span["value"])))


def _clean(text: Column) -> Column:
    """Without the marks, at unchanged length."""
    return F.translate(F.coalesce(text, F.lit("")), _OPEN + _CLOSE, _OTHER + _OTHER)


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, clean (the text without the marks), an array of checked matches for each kind, and entities (distinct)."""
    found = docs.select("doc_id", _clean(F.col("text")).alias("clean"))
    found = found.withColumns({kind: _checked(kind, F.col("clean")) for kind in KINDS})
    every = F.concat(*(_entities(kind) for kind in KINDS))
    return found.withColumn("entities", F.array_distinct(every))


def _masked(clean: Column, identifiers: Column) -> Column:
    """The text with a private-use character for each of the identifiers' characters.

    Cut in UTF-32, where a place is found without reading what stands before it.
    """
    wide = F.encode(clean, "UTF-32")
    cut = lambda at, n: F.decode(F.substring(wide, 4 * at + 1, 4 * n), "UTF-32")

    def step(done: Column, span: Column) -> Column:
        end = span["start"] + F.length(span["value"])
        gap = F.when(span["start"] > done["at"], cut(done["at"], span["start"] - done["at"])).otherwise("")
        hidden = F.repeat(F.lit(_OTHER), F.greatest(end - F.greatest(span["start"], done["at"]), F.lit(0)))
        return F.struct(F.greatest(end, done["at"]).alias("at"), F.concat(done["parts"], F.array(gap, hidden)).alias("parts"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    whole = F.aggregate(F.array_sort(identifiers), start, step, lambda done: F.concat(F.array_join(done["parts"], ""), cut(done["at"], F.length(clean))))
    return F.when(F.size(identifiers) > 0, whole).otherwise(clean)


def _terms(masked: Column, least: int) -> Column:
    """The distinct terms of a text without identifiers."""
    runs = F.split(masked, f"[^{_IN_TERM}]+")
    return F.array_distinct(F.filter(runs, lambda run: (F.length(run) > 0) & ~((F.length(run) < least) & run.rlike("^[a-z]+$"))))


def _classed(rows: DataFrame, name: str, *counts: str) -> DataFrame:
    """rows (name, id, hash, weight, counts) with class: the least of the names that stand in exactly the same documents.

    The documents are named by two sums of 31 bits of a hash, and their number.
    """
    hashed = rows.withColumn("h", F.xxhash64("id", "hash"))
    part = lambda shift: F.sum(F.shiftrightunsigned("h", shift).bitwiseAND(F.lit(2**31 - 1)))
    sums = hashed.groupBy(name, *counts).agg(F.sum("weight").alias("documents"), part(0).alias("low"), part(32).alias("high"))
    same = [*counts, "documents", "low", "high"]
    return sums.join(sums.groupBy(*same).agg(F.min(name).alias("class")), same).select(name, "class", "documents", *counts)


def disclosing_terms(found: DataFrame, scratch: Scratch, how: Disclosure) -> DataFrame:
    """For documents with an entity and a term that reveals it: id, hash (which together name a document's text) and terms.

    found has id, hash, entities, clean (masked; null where there is no entity) and vocabulary (hashes of the distinct
    terms of every document, for counting).

    Terms of a document meet its entities by classes, as all that stand in the same documents have the same counts:
    a list of entities beside a list of terms, copied a few times, is one pair.  A term also meets only entities that
    it could reveal: as no more documents can have both than have the entity, its own documents are
    n(entity) (n / n(entity)) ^ (1 - disclosure) at most.
    """
    documents = found.count()
    n = F.lit(float(documents))
    one = F.lit(1).cast("long")
    rows = found.where(F.size("entities") > 0).groupBy("id", "hash").agg(F.count(one).alias("weight"), F.first("clean").alias("clean"), F.first("entities").alias("entities"))
    rows = scratch.save(rows, "rows")
    entities = rows.select("id", "hash", "weight", F.explode("entities").alias("entity"))
    frequent = scratch.save(_classed(entities, "entity").where(F.col("documents") >= how.support).select("entity", "class", F.col("documents").alias("n_entity")), "entities")
    # Entities of the documents that a term could reveal; both sides are plain scans, so that a hot entity's rows can be split.
    held = scratch.save(entities.join(frequent, "entity").select("id", "hash", F.col("class").alias("entity"), "n_entity").distinct(), "held")
    most = F.col("n_entity") * F.pow(n / F.col("n_entity"), F.lit(1 - how.disclosure)) + 1e-6
    limit = held.agg(F.max(most)).head()[0]
    if limit is None:
        return rows.limit(0).select("id", "hash", "clean", F.array().cast("array<string>").alias("terms"))
    texts = rows.join(held.select("id", "hash").distinct(), ["id", "hash"], "left_semi")
    terms = texts.select("id", "hash", "weight", F.explode(_terms(F.col("clean"), how.min_letters)).alias("term")).withColumn("word", F.xxhash64("term"))
    terms = scratch.save(terms, "terms")
    words = found.select(F.explode("vocabulary").alias("word")).groupBy("word").agg(F.count(one).alias("n_term"))
    words = words.where((F.col("n_term") >= how.support) & (F.col("n_term") <= limit))
    words = scratch.save(words.join(terms.select("word").distinct(), "word", "left_semi"), "words")
    terms = scratch.save(terms.join(words, "word").select("id", "hash", "weight", "term", "n_term"), "counted")
    classes = scratch.save(_classed(terms, "term", "n_term").where(F.col("documents") >= how.support), "classes")
    placed = scratch.save(terms.join(classes.select("term", "class"), "term"), "placed")
    of_class = placed.select("id", "hash", "weight", "class", "n_term").distinct()
    pairs = of_class.join(held, ["id", "hash"]).where(F.col("n_term") <= most)
    together = pairs.groupBy("entity", "class", "n_entity", "n_term").agg(F.sum("weight").alias("n_both")).where(F.col("n_both") >= how.support)
    information = F.log2(n / F.col("n_entity"))
    mutual = F.log2(F.col("n_both") * n / (F.col("n_term") * F.col("n_entity")))
    revealing = scratch.save(together.where((information > 0) & (mutual >= F.lit(how.disclosure) * information)).select("entity", "class"), "revealing")
    told = pairs.join(revealing, ["entity", "class"]).select("id", "hash", "class").distinct()
    listed = placed.join(told, ["id", "hash", "class"]).groupBy("id", "hash").agg(F.array_sort(F.collect_set("term")).alias("terms"))
    return rows.join(listed, ["id", "hash"]).select("id", "hash", "clean", "terms")


def personal_data(docs: DataFrame, how: Disclosure = Disclosure()) -> DataFrame:
    """doc_id, an array of (start, value) for each kind of identifier, and revealing (terms, likewise), for every whole text.

    A null text counts as empty and has no span; a null doc_id stays null; repeated rows count as documents
    each for itself and each give a row; an empty table gives no row.  Only doc_id and text are read.
    Terms never overlap identifiers.
    """
    scratch = Scratch(docs.sparkSession, "pii")
    found = base_spans(docs)
    found = found.withColumn("masked", _masked(F.col("clean"), F.concat(*(F.col(kind) for kind in KINDS))))
    found = found.select(
        "doc_id",
        F.coalesce("doc_id", F.lit(-(2**63))).alias("id"),
        F.xxhash64("clean").alias("hash"),
        *KINDS,
        "entities",
        F.when(F.size("entities") > 0, F.col("masked")).alias("clean"),
        F.transform(_terms(F.col("masked"), how.min_letters), lambda word: F.xxhash64(word)).alias("vocabulary"),
    )
    found = scratch.save(found, "found")
    terms = disclosing_terms(found, scratch, how)
    # Terms have nothing that means something in a pattern.
    pattern = F.concat(F.lit(f"(?<![{_IN_TERM}])(?:"), F.array_join("terms", "|"), F.lit(f")(?![{_IN_TERM}])"))
    marked = F.split(F.regexp_replace("clean", pattern, F.lit(f"{_OPEN}$0{_CLOSE}")), _OPEN)
    located = terms.select("id", "hash", marked.alias("parts")).select("id", "hash", _added_up(F.col("parts")).alias("places"))
    located = scratch.save(located, "located")
    whole = found.select("doc_id", "id", "hash", *KINDS).join(located, ["id", "hash"], "left")
    return whole.select("doc_id", *KINDS, F.coalesce("places", _no_spans()).alias("revealing"))


def digest(docs: DataFrame, how: Disclosure = Disclosure()) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 (of the identifiers' kind:start:end, comma-joined) and spans (all, likewise); ends are exclusive."""
    found = personal_data(docs, how)
    base = F.concat(*(_listed(kind, F.col(kind)) for kind in KINDS))
    every = F.concat(base, _listed(TERM, F.col("revealing")))
    return found.select(
        "doc_id",
        *(F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS),
        F.sha2(F.encode(F.array_join(base, ","), "UTF-8"), 256).alias("base_sha256"),
        F.array_join(every, ",").alias("spans"),
    )


def sanitise(text: Column, spans: Column) -> Column:
    """The text with identifiers generalised to their kind in brackets and revealing terms removed.

    spans is the string of digest(); where spans overlap, the one that starts first (then the longer) holds.
    """
    listed = F.filter(F.split(spans, ","), lambda span: F.length(span) > 0)
    typed = F.transform(
        listed,
        lambda span: F.struct(
            F.split_part(span, F.lit(":"), F.lit(2)).cast("int").alias("start"), (-F.split_part(span, F.lit(":"), F.lit(3)).cast("int")).alias("minus_end"), F.split_part(span, F.lit(":"), F.lit(1)).alias("kind")
        ),
    )

    def step(done: Column, span: Column) -> Column:
        label = F.when(span["kind"] == TERM, F.lit("")).otherwise(F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]")))
        before = F.substring(text, done["at"] + 1, span["start"] - done["at"])
        taken = F.struct((-span["minus_end"]).alias("at"), F.concat(done["out"], before, label).alias("out"))
        return F.when(span["start"] >= done["at"], taken).otherwise(done)

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    return F.aggregate(F.array_sort(typed), start, step, lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))
