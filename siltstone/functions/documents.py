"""Expressions over JSON documents that models return: tolerant parsing, scores, tags and captions.

Facets may be a string or a list, so documents are variants: a declared struct would turn a scalar facet into null.
Objects that repeat a key do not parse and count as unparseable.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.functions import vocabulary as v
from siltstone.functions.scalars import bind, sentence, snake, truthy

_NONE = "array<string>"


def empty_list() -> Column:
    return F.array().cast(_NONE)


def parse(raw: Column) -> Column:
    """A variant; doubled quotes and a trailing comma are repaired where the text does not parse as it is."""
    mended = F.regexp_replace(F.trim(F.replace(raw, F.lit('""'), F.lit('"'))), ",+$", "")
    return F.coalesce(F.try_parse_json(raw), F.try_parse_json(mended))


def is_object(doc: Column) -> Column:
    return F.coalesce(F.schema_of_variant(doc).startswith("OBJECT"), F.lit(False))


def json_block(reply: Column) -> Column:
    """From the first brace to the last; null without such a block."""
    return F.nullif(F.regexp_extract(reply, r"(?s)\{.*\}", 0), F.lit(""))


def last_json_block(reply: Column) -> Column:
    """From the first brace to a brace at the end, once code fences are stripped."""
    bare = F.regexp_replace(F.trim(reply), r"^[` \t\n\r]+|[` \t\n\r]+$", "")
    return F.nullif(F.regexp_extract(bare, r"(?s)\{.*\}\s*$", 0), F.lit(""))


def at(doc: Column, key: str) -> Column:
    return F.try_variant_get(doc, f'$["{key}"]', "variant")


def score_of(value: Column) -> Column:
    """0..100 from a number, numeric text or boolean; halves round to even; null where there is no number."""
    kind = F.schema_of_variant(value)
    d = F.when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean").cast("double")).when(kind == "STRING", F.trim(F.try_variant_get(value, "$", "string")).try_cast("double")).otherwise(F.try_variant_get(value, "$", "double"))
    return F.when(~F.isnan(d) & (F.abs(d) < 1e18), F.greatest(F.lit(0), F.least(F.lit(100), F.bround(d))).cast("int"))


def parse_scores(reply: Column) -> Column:
    """Struct (relevance, aesthetic), null unless both parse.  A long key beats its short form even if it is null."""

    def of(doc: Column) -> Column:
        rel, aes = (score_of(F.coalesce(at(doc, long_), at(doc, short))) for long_, short in (("relevance", "r"), ("aesthetic", "a")))
        return F.when(rel.isNotNull() & aes.isNotNull(), F.struct(rel.alias("relevance"), aes.alias("aesthetic")))

    return bind(F.try_parse_json(json_block(reply)), of)


def flag(doc: Column, key: str) -> Column:
    """A boolean facet; numbers count if not 0, text by the one definition of truth."""
    x = at(doc, key)
    kind = F.schema_of_variant(x)
    value = F.when(kind == "BOOLEAN", F.try_variant_get(x, "$", "boolean")).when(kind == "STRING", truthy(F.try_variant_get(x, "$", "string"))).otherwise(F.try_variant_get(x, "$", "double") != 0)
    return F.coalesce(value, F.lit(False))


def values(doc: Column, key: str, scalar: bool = True) -> Column:
    """A facet as a list of text with its nulls: a list as it is, a scalar as a list of one (unless told not to)."""
    x = at(doc, key)
    kind = F.schema_of_variant(x)
    out = F.when(kind.startswith("ARRAY"), F.try_variant_get(x, "$", _NONE))
    if scalar:
        out = out.when(~kind.startswith("OBJECT") & (kind != "VOID"), F.array(F.try_variant_get(x, "$", "string")))
    return F.coalesce(out, empty_list())


def names(doc: Column) -> Column:
    """The list of names under either key; the first that holds any wins."""
    return bind(values(doc, v.NAME_KEY), lambda a: F.when(F.size(a) > 0, a).otherwise(values(doc, v.PLAIN_NAME_KEY)))


def name_list(doc: Column) -> Column:
    """Trimmed lower-case names of a list (scalars do not count), without blanks."""
    listed = bind(values(doc, v.NAME_KEY, scalar=False), lambda a: F.when(F.size(a) > 0, a).otherwise(values(doc, v.PLAIN_NAME_KEY, scalar=False)))
    return F.filter(F.transform(listed, lambda x: F.lower(F.trim(x))), lambda x: x != "")


def is_nameless(raw: Column) -> Column:
    """Whether a tag document holds no name that is not blank; what does not parse holds none."""
    found = values(parse(raw), v.NAME_KEY)
    return F.coalesce(~F.exists(found, lambda x: F.coalesce(F.trim(x) != "", F.lit(False))), F.lit(True))


def snake_list(items: Column) -> Column:
    """Snake-cased, without blanks and repeats; nulls stay, each of them."""
    cleaned = F.filter(F.transform(items, lambda x: F.when(x.isNotNull(), snake(x))), lambda x: x.isNull() | (x != ""))
    return bind(cleaned, lambda c: F.filter(c, lambda x, i: x.isNull() | (F.array_position(c, x) == i + 1)))


def _pairs(raw_names: Column, raw_forms: Column) -> Column:
    """(name, form) of equal length, snake-cased; repeated pairs and blank names go together, so both stay aligned."""
    zipped = F.transform(raw_names, lambda n, i: F.struct(F.when(n.isNotNull(), snake(n)).alias("name"), F.nullif(snake(F.get(raw_forms, i)), F.lit("")).alias("form")))
    return F.array_distinct(F.filter(zipped, lambda p: p["name"].isNull() | (p["name"] != "")))


def coerce_tags(doc: Column) -> Column:
    """The full tag document as a struct: all keys, aligned forms, closed vocabularies, booleans and lists.

    ``trimmed`` tells that there were more forms than names.
    """
    raw_names, raw_forms = values(doc, v.NAME_KEY), values(doc, "form")

    def allowed(key: str, words: tuple[str, ...]) -> Column:
        return F.filter(values(doc, key, scalar=False), lambda x: x.isin(*words))

    def either(key: str) -> Column:
        known = at(doc, key).isNotNull()
        former = F.lit(False)
        for old in reversed(v.FORMER_KEYS.get(key, ())):
            former = F.when(at(doc, old).isNotNull(), flag(doc, old)).otherwise(former)
        return F.when(known, flag(doc, key)).otherwise(former)

    count = F.try_variant_get(at(doc, "subject_count"), "$", "string")

    def whole(pairs: Column) -> Column:
        return F.struct(
            F.transform(pairs, lambda p: p["name"]).alias("names"), F.transform(pairs, lambda p: p["form"]).alias("form"),
            *[either(k).alias(k) for k in ("shiny_presence", "trainer_presence", "gijinka_humanoid", "multi_panel")],
            F.when(count.isin("single", "multiple"), count).otherwise("single").alias("subject_count"),
            *[snake_list(values(doc, k, scalar=False)).alias(k) for k in v.SNAKE_FACETS],
            F.slice(allowed("composition", v.COMPOSITIONS), 1, 2).alias("composition"), allowed("art_style", v.ART_STYLES).alias("art_style"),
            (F.size(raw_forms) > F.size(raw_names)).alias("trimmed"),
        )

    return F.when(is_object(doc), bind(_pairs(raw_names, raw_forms), whole))


def parse_caption(reply: Column) -> Column:
    """Struct (sentence, tags) of a captioner's reply; null where it holds no object."""

    def of(doc: Column) -> Column:
        tags = bind(at(doc, "tags"), lambda t: F.coalesce(coerce_tags(t), coerce_tags(F.parse_json(F.lit("{}")))))
        own = at(doc, "sentence")
        said = F.when(F.schema_of_variant(own) == "STRING", sentence(F.try_variant_get(own, "$", "string"))).otherwise(F.when(own.isNotNull(), F.lit("")).otherwise("."))
        return F.when(is_object(doc), F.struct(said.alias("sentence"), tags.alias("tags")))

    return bind(F.try_parse_json(last_json_block(reply)), of)


def with_form(name: Column, form: Column, shiny: Column) -> Column:
    """A name with its form before it, or around it for mega forms; shiny before all."""
    said = F.replace(name, F.lit("_"), F.lit(" "))
    f = snake(form)
    around = {"": ("", ""), **{k: ("mega ", suffix) for k, suffix in v.MEGA_SUFFIXES.items()}, **{k: (prefix + " ", "") for k, prefix in v.FORM_PREFIXES.items() if k not in v.MEGA_SUFFIXES}}
    table = F.create_map(*[x for k, (before, after) in around.items() for x in (F.lit(k), F.struct(F.lit(before).alias("before"), F.lit(after).alias("after")))])
    out = bind(F.struct(f.alias("f"), said.alias("s"), F.try_element_at(table, f).alias("t")), lambda x: F.concat(F.coalesce(x["t"]["before"], F.concat(x["f"], F.lit(" "))), x["s"], F.coalesce(x["t"]["after"], F.lit(""))))
    return F.trim(F.concat(F.when(shiny, "shiny ").otherwise(""), out))


def name_tokens(doc: Column) -> Column:
    """Names with their forms; shiny applies to all, or to those listed as shiny."""
    shiny = F.filter(F.transform(values(doc, "shiny_pokemon"), snake), lambda x: x != "")

    def tokens(x: Column) -> Column:
        return F.array_distinct(F.filter(F.transform(x["n"], lambda n, i: with_form(snake(n), F.get(x["f"], i), flag(doc, "shiny_presence") & ((F.size(x["s"]) == 0) | F.array_contains(x["s"], snake(n))))), lambda t: t != ""))

    return bind(F.struct(names(doc).alias("n"), values(doc, "form").alias("f"), shiny.alias("s")), tokens)


def facet_tokens(doc: Column, key: str) -> Column:
    return F.array_distinct(F.filter(F.transform(values(doc, key), snake), lambda t: t != ""))


def compose(said: Column, doc: Column) -> Column:
    """``sentence | token, token``: names, facets in fixed order, then counts and flags; the sentence alone without."""
    s = F.trim(F.coalesce(said, F.lit("")))
    count = snake(F.try_variant_get(at(doc, "subject_count"), "$", "string"))
    tail = [F.when(count.isin("single", "multiple"), count), F.when(flag(doc, "trainer_presence"), F.lit("trainer")), F.when(flag(doc, "gijinka_humanoid"), F.lit("gijinka")), F.when(flag(doc, "multi_panel"), F.lit("multi_panel"))]
    tokens = F.concat(name_tokens(doc), *[facet_tokens(doc, k) for k in v.CAPTION_FACETS], F.array_compact(F.array(*tail)))
    return bind(tokens, lambda t: F.when(is_object(doc) & (F.size(t) > 0), F.concat(s, F.lit(" | "), F.array_join(t, ", "))).otherwise(s))


def confidence(field: Column) -> Column:
    """Confidence from a number, a (text, number) pair or an object with a score; 1 where it has none of these."""
    kind = F.schema_of_variant(field)
    own = F.when(kind.startswith("ARRAY"), F.try_variant_get(field, "$[1]", "double")).when(kind.startswith("OBJECT"), F.try_variant_get(field, "$.score", "double")).when(kind != "STRING", F.try_variant_get(field, "$", "double"))
    return F.coalesce(own, F.lit(1.0))
