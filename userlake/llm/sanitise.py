"""Personal data, and the terms that give it away. DataFrame functions only.

Values of fixed kinds (e-mail, IP address, card and phone number) are found by
pattern and rule and are the protected entities. Around each mention the words
nearby are candidate terms. How strongly a term reveals an entity is estimated
from the whole corpus: the pointwise mutual information of term and entity, as
a share of the information content of the entity,

    ln(N * n_both / (n_term * n_entity)) / ln(N / n_entity)

where n_both counts documents with the term near the entity, n_term and
n_entity all documents with either, and N all documents. A share of 1 means
that the term tells the entity. Terms above one bound are generalised, above a
higher one removed, wherever they stand in documents that mention the entity.
Evidence must come from several different surroundings, so that copies of one
text make no evidence.

Defined cases: a null text is empty and has no spans; matches that fail their
rule are dropped without another try; repeated rows are treated each; rows
without doc_id are told apart by their texts; an empty table gives an empty
result; further columns are kept.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from userlake.llm.common import by_merge, stored, unique_names

# Fixed: the kinds in their order, and how they look. Lookbehinds and possessive
# repetition give the same matches as without, in time linear in the text.
KINDS = ("email", "ip", "card", "phone")
LOCAL, LABEL = "A-Za-z0-9._%+-", "A-Za-z0-9-"
PATTERNS = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[{LABEL}]++(?:\.[{LABEL}]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
CARD_DIGITS, PHONE_DIGITS = (13, 19), (9, 15)
TERM = "term"

# Characters on either side of a mention in which its nearest terms are sought, and how many of them.
NEAR_CHARS, NEAR_TERMS = 160, 8
MIN_SURROUNDINGS = 3
GENERALISE, REMOVE = 0.8, 0.95

SPAN = "struct<s:int,e:int,v:string>"
_WORD_CHARACTERS = r"\p{L}\p{N}@._%+-"
TERM_PATTERN = rf"(?<![{_WORD_CHARACTERS}])\p{{L}}{{3,}}+(?![\p{{L}}\p{{N}}@_%+])"


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def spans_of(text: str, pattern: str, valid: str = "true") -> Column:
    """Places and values of a pattern's matches in the column `text`; `valid` is SQL on a match `m`.

    The text is split at the matches; the lengths of gaps and matches, added
    up, are the places, in code points.
    """
    valid = valid.replace("$m", "x.`1`")
    return F.expr(f"""
        aggregate(
          arrays_zip(split({text}, {_quoted(pattern)}, -1), regexp_extract_all({text}, {_quoted(pattern)}, 0)),
          named_struct('p', 0, 'out', CAST(array() AS array<{SPAN}>)),
          (acc, x) -> named_struct(
            'p', acc.p + length(x.`0`) + coalesce(length(x.`1`), 0),
            'out', IF(x.`1` IS NOT NULL AND {valid},
                      concat(acc.out, array(named_struct(
                        's', acc.p + length(x.`0`), 'e', acc.p + length(x.`0`) + length(x.`1`), 'v', x.`1`))),
                      acc.out)),
          acc -> acc.out)""")


_DIGITS = "regexp_replace($m, '[^0-9]', '')"
# Every second digit from the right is doubled, nines cast out; the sum ends in zero.
_LUHN = f"""aggregate(
    transform(split(reverse({_DIGITS}), ''), (d, i) -> CASE
      WHEN d = '' THEN 0 WHEN i % 2 = 0 THEN int(d) WHEN int(d) > 4 THEN 2 * int(d) - 9 ELSE 2 * int(d) END),
    0, (total, d) -> total + d) % 10 = 0"""
VALID = {
    "email": "true",
    "ip": "$m RLIKE " + _quoted(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
    "card": f"length({_DIGITS}) BETWEEN {CARD_DIGITS[0]} AND {CARD_DIGITS[1]} AND {_LUHN}",
    "phone": f"length({_DIGITS}) BETWEEN {PHONE_DIGITS[0]} AND {PHONE_DIGITS[1]}",
}
# A text without this cannot have the kind, which spares most texts the patterns.
HINT = {
    "email": r"@",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){12}",
    "phone": r"\+[0-9]",
}


def base_spans(text: str) -> dict[str, Column]:
    """Of each kind the spans in a text column without nulls."""
    none = F.array().cast(f"array<{SPAN}>")
    return {
        kind: F.when(F.col(text).rlike(HINT[kind]), spans_of(text, PATTERNS[kind], VALID[kind])).otherwise(none)
        for kind in KINDS
    }


def entity(kind: str, value: Column) -> Column:
    """What a mention stands for: letter case and separators do not count."""
    plain = {"email": F.lower(value), "ip": value}.get(kind, F.regexp_replace(value, "[^0-9]", ""))
    return F.concat(F.lit(f"{kind}:"), plain)


def _mention(kind: str, span: Column) -> Column:
    """Entity and nearest terms of a mention, and a hash of these; words at the far edges may be cut and are left out."""
    start, end = span["s"], span["e"]
    left = F.substring(F.col("_text"), F.greatest(start - NEAR_CHARS, F.lit(0)) + 1, F.least(start, F.lit(NEAR_CHARS)))
    right = F.substring(F.col("_text"), end + 1, F.lit(NEAR_CHARS))
    before = F.regexp_extract_all(F.regexp_replace(left, r"^\S*", ""), F.lit(TERM_PATTERN), 0)
    after = F.regexp_extract_all(F.regexp_replace(right, r"\S*$", ""), F.lit(TERM_PATTERN), 0)
    nearest = F.slice(before, F.greatest(F.size(before) - NEAR_TERMS, F.lit(0)) + 1, F.lit(NEAR_TERMS))
    terms = F.transform(F.concat(nearest, F.slice(after, 1, NEAR_TERMS)), F.lower)
    return F.struct(
        entity(kind, span["v"]).alias("entity"),
        F.array_distinct(terms).alias("terms"),
        F.xxhash64(F.array_join(terms, " ")).alias("surroundings"),
    )


def _keyed(documents: DataFrame) -> DataFrame:
    """doc_id, `_text` without nulls, and `text_key`, which tells rows of one doc_id apart by their texts."""
    whole = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    return whole.withColumn("text_key", F.xxhash64("_text"))


def found(documents: DataFrame) -> DataFrame:
    """doc_id, text_key, `bases` (spans of each kind), `near` (terms around each mention) and `entities`."""
    spans = {kind: column.alias(f"_{kind}") for kind, column in base_spans("_text").items()}

    def of_all(make) -> Column:
        return F.flatten(F.array(*[F.transform(F.col(f"_{kind}"), partial(make, kind)) for kind in KINDS]))

    return _keyed(documents).select("*", *spans.values()).select(
        "doc_id",
        "text_key",
        F.struct(*[F.col(f"_{kind}").alias(kind) for kind in KINDS]).alias("bases"),
        of_all(_mention).alias("near"),
        F.array_distinct(of_all(lambda kind, span: entity(kind, span["v"]))).alias("entities"),
    )


def document_frequencies(documents: DataFrame) -> DataFrame:
    """Documents with each lower-case term, over the whole corpus."""
    terms = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(TERM_PATTERN), 0))
    return documents.select(F.explode(terms).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))


def disclosing_terms(documents: DataFrame, rows: DataFrame) -> DataFrame:
    """(entity, term, removed): the terms that reveal an entity beyond the bounds."""
    total = float(rows.count())
    mentions = rows.select("doc_id", "text_key", F.explode("near").alias("m"))
    terms = mentions.select("doc_id", "text_key", "m.entity", F.explode("m.terms").alias("term"), "m.surroundings")
    key = ["entity", "term"]
    evident = (
        terms.select(*key, "surroundings").distinct().groupBy(*key).agg(F.count("*").alias("n_surroundings"))
        .where(F.col("n_surroundings") >= MIN_SURROUNDINGS)
    )
    both = terms.select("doc_id", "text_key", *key).distinct().groupBy(*key).agg(F.count("*").alias("n_both"))
    entities = rows.select("doc_id", "text_key", F.explode("entities").alias("entity")).distinct()
    sizes = entities.groupBy("entity").agg(F.count("*").alias("n_entity")).where(F.col("n_entity") < total)
    share = F.log(F.lit(total) * F.col("n_both") / (F.col("n_term") * F.col("n_entity"))) / F.log(
        F.lit(total) / F.col("n_entity")
    )
    return (
        evident.join(by_merge(both), key)
        .join(by_merge(sizes), "entity")
        .join(by_merge(document_frequencies(documents)), "term")
        .withColumn("share", share)
        .where(F.col("share") >= GENERALISE)
        .select(*key, (F.col("share") >= REMOVE).alias("removed"))
    )


def term_spans(documents: DataFrame, rows: DataFrame, terms: DataFrame) -> DataFrame:
    """_id, _key and the spans of disclosing terms, for the documents that have any."""
    held = (
        rows.select("doc_id", "text_key", "bases", F.explode("entities").alias("entity"))
        .join(by_merge(terms), "entity")
        .groupBy("doc_id", "text_key")
        .agg(
            F.first("bases").alias("bases"),
            F.collect_set("term").alias("terms"),
            F.collect_set(F.when(F.col("removed"), F.col("term"))).alias("gone"),
        )
        .select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), "bases", "terms", "gone")
    )
    given = _keyed(documents)
    joined = given.join(held, (F.col("text_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    base = F.flatten(F.array(*[F.col("bases")[kind] for kind in KINDS]))
    hits = F.filter(
        spans_of("_text", TERM_PATTERN),
        lambda t: F.array_contains(F.col("terms"), F.lower(t["v"]))
        & ~F.exists(base, lambda b: (b["s"] < t["e"]) & (t["s"] < b["e"])),
    )
    place = lambda t: F.struct(
        t["s"].alias("s"), t["e"].alias("e"), F.array_contains(F.col("gone"), F.lower(t["v"])).alias("gone")
    )
    return joined.select("_id", "_key", F.transform(hits, place).alias("term_spans")).dropDuplicates(["_id", "_key"])


def all_spans(documents: DataFrame) -> DataFrame:
    """doc_id, text_key, `bases` and `term_spans` (with `gone` where removed) of each document."""
    rows = stored(found(documents), "personal-data")
    terms = stored(disclosing_terms(documents, rows), "disclosing-terms")
    extra = term_spans(documents, rows, terms)
    joined = rows.join(extra, (F.col("text_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    return joined.select("doc_id", "text_key", "bases", "term_spans")


def digests(spans: DataFrame) -> DataFrame:
    """Counts of each kind, digest of the base spans, and all spans as text."""

    def listed(kind: str, items: Column) -> Column:
        return F.transform(
            items, lambda x: F.concat_ws(":", F.lit(kind), x["s"].cast("string"), x["e"].cast("string"))
        )

    base = F.flatten(F.array(*[listed(kind, F.col("bases")[kind]) for kind in KINDS]))
    terms = F.coalesce(listed(TERM, F.col("term_spans")), F.array().cast("array<string>"))
    return spans.select(
        "doc_id",
        *[F.size(F.col("bases")[kind]).cast("bigint").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, terms), ",").alias("spans"),
        F.coalesce(F.size("term_spans"), F.lit(0)).cast("bigint").alias("n_terms"),
    )


def rewritten(text: str, spans: Column) -> Column:
    """The text with each span (s, e, label), sorted, in place of what it covers; overlapping spans become one."""
    merged = F.aggregate(
        spans,
        F.expr("CAST(array() AS array<struct<s:int,e:int,label:string>>)"),
        lambda out, x: F.when(
            (F.size(out) > 0) & (F.try_element_at(out, F.lit(-1))["e"] > x["s"]),
            F.concat(
                F.slice(out, F.lit(1), F.size(out) - 1),
                F.array(
                    F.struct(
                        F.try_element_at(out, F.lit(-1))["s"].alias("s"),
                        F.greatest(F.try_element_at(out, F.lit(-1))["e"], x["e"]).alias("e"),
                        F.try_element_at(out, F.lit(-1))["label"].alias("label"),
                    )
                ),
            ),
        ).otherwise(F.concat(out, F.array(x))),
    )
    bounds = F.concat(F.array(F.struct(F.lit(0).alias("s"), F.lit(0).alias("e"), F.lit("").alias("label"))), merged)
    pieces = F.zip_with(
        bounds,
        merged,
        lambda before, x: F.concat(
            before["label"],
            F.substring(F.col(text), before["e"] + 1, F.coalesce(x["s"], F.length(F.col(text))) - before["e"]),
        ),
    )
    return F.array_join(pieces, "")


def sanitised(documents: DataFrame) -> DataFrame:
    """The documents with personal data and disclosing terms replaced; n_chars follows the text where there is such a column.

    A value becomes the name of its kind, a generalised term the word for one,
    and a removed term nothing.
    """
    names = unique_names(documents, "text", "text_key", "id", "key", *KINDS, "terms", "spans", "new")
    given = documents.withColumn(names["text"], F.coalesce("text", F.lit(""))).withColumn(
        names["text_key"], F.xxhash64(names["text"])
    )
    rows = stored(found(documents.select("doc_id", "text")), "personal-data")
    terms = stored(disclosing_terms(documents, rows), "disclosing-terms")
    extra = term_spans(documents, rows, terms).select(
        F.col("_id").alias(names["id"]), F.col("_key").alias(names["key"]), F.col("term_spans").alias(names["terms"])
    )
    joined = given.join(
        extra,
        (F.col(names["text_key"]) == F.col(names["key"])) & F.col("doc_id").eqNullSafe(F.col(names["id"])),
        "left",
    )
    labelled = lambda items, label: F.transform(
        items, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), label.alias("label"))
    )
    spans = F.concat(
        *[labelled(F.col(names[kind]), F.lit(f"[{kind}]")) for kind in KINDS],
        *[
            F.coalesce(
                labelled(F.filter(F.col(names["terms"]), lambda x: x["gone"] == gone), F.lit(label)),
                F.expr("CAST(array() AS array<struct<s:int,e:int,label:string>>)"),
            )
            for gone, label in ((F.lit(True), ""), (F.lit(False), f"[{TERM}]"))
        ],
    )
    changed = F.size(names["spans"]) > 0
    columns = {
        "text": F.when(changed, rewritten(names["text"], F.col(names["spans"]))).otherwise(F.col("text"))
    }
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        columns["n_chars"] = F.when(changed, F.length(names["new"]).cast(kind)).otherwise(F.col("n_chars"))
    return (
        joined.select("*", *[c.alias(names[kind]) for kind, c in base_spans(f"`{names['text']}`").items()])
        .withColumn(names["spans"], F.array_sort(spans))
        .withColumn(names["new"], columns["text"])
        .select(
            *[
                F.col(names["new"]).alias("text") if c == "text"
                else columns["n_chars"].alias(c) if c == "n_chars"
                else F.col(f"`{c}`")
                for c in documents.columns
            ]
        )
    )
