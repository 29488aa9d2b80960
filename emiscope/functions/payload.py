"""Expressions over a model's JSON metadata payload.

``parsed`` reads the text once into a struct of VARIANT fields. VARIANT keeps the
JSON type (``"0"`` is not ``0``), and unused keys are skipped by the parser.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from emiscope.functions.text import float_text, parse_emission, strip
from emiscope.schemas import METRIC_KEYS

# Payload keys that the row shapes read.
PAYLOAD_KEYS = (
    "id", "modelId", "author", "cardData", "card_data", "createdAt", "created_at",
    "lastModified", "downloads", "likes", "library_name", "libraryName", "pipeline_tag",
    "pipelineTag", "tags", "safetensors", "siblings", "datasets",
)
CARD_KEYS = ("cardData", "card_data")

# Canonical JSON texts that count as "nothing there".
_EMPTY_JSON = ("null", "false", "0", "0.0", "-0.0", '""', "[]", "{}")

# Stand-ins for escapes while JSON text is respaced. JSON text never holds a bare control
# character, so no text is mistaken for one.
_PARKED_SLASH, _PARKED_QUOTE = "\x01", "\x02"


def parsed(payload_json: Column, keys: tuple[str, ...] = PAYLOAD_KEYS) -> Column:
    """Payload text to a struct with one VARIANT per key; other keys are skipped."""
    return F.from_json(payload_json, ", ".join(f"`{key}` VARIANT" for key in keys))


def at(value: Column, key: str) -> Column:
    """Member ``key`` as VARIANT; NULL when absent or ``value`` is no object."""
    return F.try_variant_get(value, f"$['{key}']", "variant")


def text(value: Column) -> Column:
    """Strings unquoted, other scalars and fragments as JSON text, JSON null as NULL."""
    return F.try_variant_get(value, "$", "string")


def text_at(value: Column, key: str) -> Column:
    return F.try_variant_get(value, f"$['{key}']", "string")


def truthy(value: Column) -> Column:
    """Present and not null, false, zero or empty."""
    return F.coalesce(~F.to_json(value).isin(*_EMPTY_JSON), F.lit(False))


def either(first: Column, second: Column) -> Column:
    """``first`` when truthy, else ``second``."""
    return F.when(truthy(first), first).otherwise(second)


def is_object(value: Column) -> Column:
    return F.coalesce(F.to_json(value).startswith("{"), F.lit(False))


def is_array(value: Column) -> Column:
    return F.coalesce(F.to_json(value).startswith("["), F.lit(False))


def is_string(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value) == "STRING", F.lit(False))


def is_whole_number(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).isin("BIGINT", "BOOLEAN"), F.lit(False))


def items(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def spaced(json_text: Column) -> Column:
    """JSON text with one space after each comma and colon, and none elsewhere.

    Escaped quotes are parked first, so that every second piece between quote
    marks lies outside a string.
    """
    parked = F.replace(json_text, F.lit("\\\\"), F.lit(_PARKED_SLASH))
    parked = F.replace(parked, F.lit('\\"'), F.lit(_PARKED_QUOTE))
    pieces = F.transform(
        F.split(parked, '"'),
        lambda piece, i: F.when(
            i % 2 == 0,
            F.regexp_replace(F.regexp_replace(piece, r"\s+", ""), "([,:])", "$1 "),
        ).otherwise(piece),
    )
    joined = F.array_join(pieces, '"')
    joined = F.replace(joined, F.lit(_PARKED_QUOTE), F.lit('\\"'))
    return F.replace(joined, F.lit(_PARKED_SLASH), F.lit("\\\\"))


def spaced_json(value: Column) -> Column:
    """A VARIANT as spaced JSON text, object keys sorted; NULL and JSON null become ''."""
    missing = value.isNull() | F.is_variant_null(value)
    return F.when(missing, F.lit("")).otherwise(spaced(F.to_json(value)))


def shown(value: Column) -> Column:
    """A scalar as text; a list with its texts in single quotes, as in ``['en', 'fr']``.

    A text that holds a single quote and no double quote is put in double quotes.
    """

    def quoted(x: Column) -> Column:
        word = F.replace(text(x), F.lit("\\"), F.lit("\\\\"))
        double = word.contains("'") & ~word.contains('"')
        single = F.replace(word, F.lit("'"), F.lit("\\'"))
        return F.when(double, F.concat(F.lit('"'), word, F.lit('"'))).otherwise(
            F.concat(F.lit("'"), single, F.lit("'"))
        )

    listed = F.transform(
        items(value),
        lambda x: F.when(is_string(x), quoted(x))
        .when(F.is_variant_null(x), "None")
        .otherwise(_number_text(x)),
    )
    as_list = F.concat(F.lit("["), F.array_join(listed, ", "), F.lit("]"))
    return F.when(is_array(value), as_list).when(is_string(value), text(value)).otherwise(
        _number_text(value)
    )


def object_json(value: Column) -> Column:
    """An object as spaced JSON text; ``{}`` when it is missing or no object."""
    text_form = spaced_json(value)
    return F.when(text_form.startswith("{"), text_form).otherwise(F.lit("{}"))


# Card ---------------------------------------------------------------------------


def card(doc: Column) -> Column:
    """The card under either spelling. Only when both are given is emptiness tested."""
    camel, snake = (doc[key] for key in CARD_KEYS)
    return F.when(snake.isNull(), camel).otherwise(either(camel, snake))


def card_of(whole: Column) -> Column:
    """As ``card``, from a payload parsed whole into one VARIANT."""
    camel, snake = at(whole, "cardData"), at(whole, "card_data")
    return F.when(snake.isNull(), camel).otherwise(either(camel, snake))


def _card_key_is_camel(doc: Column) -> Column:
    return doc["card_data"].isNull() | truthy(doc["cardData"])


def card_text(payload_json: Column, doc: Column) -> Column:
    """The card as JSON text in its own key order; ``{}`` when missing or no object."""
    value = F.when(
        _card_key_is_camel(doc), F.get_json_object(payload_json, "$.cardData")
    ).otherwise(F.get_json_object(payload_json, "$.card_data"))
    return F.when(is_object(card(doc)), value).otherwise(F.lit("{}"))


def _number_text(value: Column) -> Column:
    """Scalar as text; a real keeps its fraction mark (``1.0``, not ``1``)."""
    kind = F.schema_of_variant(value)
    return F.when(
        kind.startswith("DECIMAL") | kind.isin("DOUBLE", "FLOAT"), float_text(text(value))
    ).when(kind == "BOOLEAN", F.initcap(text(value))).otherwise(text(value))


_DETAILS = ("source", "training_type", "geographical_location", "hardware_used")


def _co2_struct(emissions: Column, detail_of: Column) -> Column:
    return F.struct(
        emissions.alias("emissions"), *[text_at(detail_of, k).alias(k) for k in _DETAILS]
    )


def co2_any(card_value: Column) -> Column:
    """Emission fields as text, from a scalar or an object."""
    co2 = at(card_value, "co2_eq_emissions")
    inner = at(co2, "emissions")
    emissions = F.when(is_object(co2), _number_text(inner)).otherwise(_number_text(co2))
    return _co2_struct(emissions, co2)


def co2_truthy(card_value: Column) -> Column:
    """As ``co2_any``, but NULL when the emission entry is empty or zero."""
    co2 = at(card_value, "co2_eq_emissions")
    return F.when(truthy(co2), co2_any(card_value))


def co2_object(card_value: Column) -> Column:
    """Emission fields from an object; ``emissions`` is NULL unless it is a usable number."""
    co2 = at(card_value, "co2_eq_emissions")
    inner = at(co2, "emissions")
    number = F.when(is_string(inner), parse_emission(text(inner))).otherwise(
        F.try_variant_get(inner, "$", "double")
    )
    return _co2_struct(number, co2)


# Datasets -----------------------------------------------------------------------


def dataset_entry(doc: Column, card_value: Column) -> Column:
    """First non-empty of card ``datasets``, card ``dataset``, payload ``datasets``."""
    return either(at(card_value, "datasets"), either(at(card_value, "dataset"), doc["datasets"]))


def dataset_list(entry: Column) -> Column:
    """The entry as an array of text: a list as it is, a string as one element."""
    listed = F.transform(items(entry), lambda x: text(x))
    return (
        F.when(is_array(entry), listed)
        .when(is_string(entry), F.array(text(entry)))
        .otherwise(F.array().cast("array<string>"))
    )


def dataset_list_json(entry: Column) -> Column:
    one = F.concat(F.lit("["), spaced_json(entry), F.lit("]"))
    return F.when(is_array(entry), spaced_json(entry)).when(is_string(entry), one).otherwise("[]")


def dataset_refs(entry: Column, tags: Column) -> Column:
    """Distinct sorted references: the card's ``datasets`` entry, else ``dataset:`` tags."""
    # An entry that is not a list counts as a list of one.
    from_card = F.when(is_array(entry), F.transform(items(entry), lambda x: text(x))).otherwise(
        F.array(text(entry))
    )
    tagged = F.filter(
        F.transform(F.filter(items(tags), is_string), lambda x: text(x)),
        lambda x: x.startswith("dataset:"),
    )
    from_tags = F.transform(tagged, lambda x: F.replace(x, F.lit("dataset:"), F.lit("")))
    chosen = F.when(truthy(entry), F.filter(from_card, lambda x: x.isNotNull())).otherwise(from_tags)
    return F.array_sort(F.array_distinct(chosen))


def dataset_refs_text(refs: Column) -> Column:
    return F.when(F.size(refs) > 0, F.array_join(refs, ", "))


def dataset_text(card_value: Column) -> Column:
    """Listed datasets trimmed and joined in given order; a string stays as it is."""
    entry = at(card_value, "datasets")
    kept = F.transform(F.filter(items(entry), truthy), lambda x: strip(text(x)))
    return F.when(is_string(entry), text(entry)).when(
        is_array(entry) & (F.size(kept) > 0), F.array_join(kept, ", ")
    )


def reparsed_list(list_text: Column) -> Column:
    """JSON list text to array, after removing a backslash in front of a quote."""
    return F.from_json(F.replace(list_text, F.lit('\\"'), F.lit('"')), "array<string>")


# Metrics, size, domain ------------------------------------------------------------


def metrics_key(card_value: Column) -> Column:
    """Name of the first non-empty evaluation entry of the card."""
    return F.coalesce(*[F.when(truthy(at(card_value, k)), F.lit(k)) for k in METRIC_KEYS])


def metrics_entry(card_value: Column, key: Column) -> Column:
    """The evaluation entry under a ``metrics_key``."""
    return F.coalesce(*[F.when(key == k, at(card_value, k)) for k in METRIC_KEYS])


def metrics_text(payload_json: Column, doc: Column, key: Column, entry: Column) -> Column:
    """The evaluation entry as spaced JSON text in its own key order; '' when there is none.

    The payload text is read again only for rows that have an entry, at one path.
    """
    camel = _card_key_is_camel(doc)
    found = F.coalesce(
        *[
            F.when(
                key == k,
                F.when(camel, F.get_json_object(payload_json, f"$.cardData.{k}")).otherwise(
                    F.get_json_object(payload_json, f"$.card_data.{k}")
                ),
            )
            for k in METRIC_KEYS
        ]
    )
    return (
        F.when(key.isNull(), F.lit(""))
        .when(is_string(entry), F.to_json(entry))
        .otherwise(spaced(found))
    )


def greatest_number(value: Column) -> Column:
    """Largest number at any depth; true and false count as 1 and 0.

    Escapes go first, then string literals with one flat pattern each, so that
    long strings cost no regex recursion.
    """
    bare = F.regexp_replace(F.regexp_replace(F.to_json(value), r"\\.", ""), '"[^"]*"', "")
    found = F.regexp_extract_all(
        bare, F.lit(r"-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?|true|false"), F.lit(0)
    )
    numbers = F.transform(
        found,
        lambda x: F.when(x == "true", 1.0).when(x == "false", 0.0).otherwise(x.try_cast("double")),
    )
    return F.array_max(numbers)


def model_size(doc: Column) -> Column:
    """Whole-number ``safetensors.total``, else the sum of known file sizes, else NULL."""
    total = at(doc["safetensors"], "total")
    sizes = F.filter(
        F.transform(
            items(doc["siblings"]),
            lambda s: F.when(
                is_whole_number(at(s, "size")), F.try_variant_get(at(s, "size"), "$", "bigint")
            ),
        ),
        lambda n: n.isNotNull(),
    )
    summed = F.aggregate(sizes, F.lit(0).cast("bigint"), lambda acc, n: acc + n)
    return F.when(is_whole_number(total), F.try_variant_get(total, "$", "bigint")).when(
        F.size(sizes) > 0, summed
    )


def tag_domain(row_tag: Column, doc: Column, row_tags: Column) -> Column:
    """Pipeline tag of the row or payload, else the first tag, else the start of the tag text."""
    tags = doc["tags"]
    cut = F.substring(F.when(truthy(tags), text(tags)).otherwise(row_tags), 1, 100)
    return F.coalesce(
        F.nullif(row_tag, F.lit("")),
        F.when(truthy(doc["pipeline_tag"]), text(doc["pipeline_tag"])),
        F.when(truthy(tags) & is_array(tags), text(F.get(items(tags), F.lit(0)))),
        F.when(~truthy(tags) | is_string(tags), F.nullif(cut, F.lit(""))),
    )


def mentions_auto(doc: Column, row_tags: Column) -> Column:
    """Whether the tags, of the payload or else of the row, mention automation."""
    tags = doc["tags"]
    joined = F.when(
        is_array(tags), F.array_join(F.transform(items(tags), lambda t: text(t)), " ")
    ).otherwise(text(tags))
    chosen = F.when(truthy(tags), joined).otherwise(row_tags)
    return F.coalesce(F.lower(chosen).contains("auto"), F.lit(False))


def ratio(amount: Column, base: Column) -> Column:
    return F.when(base > 0, amount / base)


def sorted_json(payload_json: Column) -> Column:
    """JSON object text with its keys in order, at every depth.

    VARIANT stores object keys sorted, so one round trip orders them all.
    """
    return spaced_json(F.try_parse_json(payload_json))
