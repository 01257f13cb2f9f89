"""JSON found in model output: locate it, parse it, check its records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .text import strip

_END = "\\u0000end"
REQUIRED_TEXT = ["platform", "post_url", "post_title", "summary"]
OPTIONAL_TEXT = ["author_handle", "posted_at"]
TEXT_LISTS = ["categories", "competitors"]


def with_strict_json(df: DataFrame, source: str, target: str) -> DataFrame:
    """The variant that a text holds, NULL where it is not exactly one JSON value.
    The parser stops after the first value, so a marker member behind it shows
    that nothing else followed."""
    wrapped = F.concat(F.lit('{"v":'), F.col(source), F.lit(f',"{_END}":1}}'))
    whole = F.try_variant_get("_wrapped", "$['\x00end']", "int") == 1
    return (
        df.withColumn("_wrapped", F.try_parse_json(wrapped))
        .withColumn(target, F.when(whole, F.try_variant_get("_wrapped", "$.v", "variant")))
        .drop("_wrapped")
    )


def with_response_text(df: DataFrame, payload: str, target: str) -> DataFrame:
    """Text of a model response (a JSON string): ``output_text`` if it is a
    string, else the text items joined by line breaks, else NULL."""
    parsed = with_strict_json(df, payload, "_parsed")
    direct = F.when(
        kind(member(F.col("_parsed"), "output_text")) == "STRING",
        F.try_variant_get("_parsed", "$.output_text", "string"),
    )
    contents = F.filter(
        F.try_variant_get(
            "_parsed", "$.output", "array<struct<content:array<struct<type:string,text:string>>>>"
        ),
        lambda i: i["content"].isNotNull(),
    )
    items = F.filter(
        F.flatten(F.transform(contents, lambda i: i["content"])),
        lambda c: c["type"].isin("output_text", "text") & c["text"].isNotNull(),
    )
    staged = parsed.withColumns({"_direct": direct, "_items": items})
    joined = F.when(
        F.size("_items") > 0, F.array_join(F.transform("_items", lambda c: c["text"]), "\n")
    )
    return staged.withColumn(target, F.coalesce("_direct", joined)).drop(
        "_parsed", "_direct", "_items"
    )


def with_json(df: DataFrame, source: str, target: str) -> DataFrame:
    """The JSON value in a text: the text without code fences if that parses,
    else everything from the first ``{`` to the last ``}``, else NULL."""
    bare = F.btrim("_stripped", F.lit("`"))
    unfenced = F.when(
        F.col("_stripped").startswith("```"),
        F.when(
            F.lower(F.left(bare, F.lit(4))) == "json",
            strip(F.substring(bare, 5, 2**31 - 1)),
        ).otherwise(bare),
    ).otherwise(F.col("_stripped"))
    braced = F.nullif(F.regexp_extract("_unfenced", r"(?s)(\{.*\})", 1), F.lit(""))
    cut = df.withColumn("_stripped", strip(F.col(source))).withColumn("_unfenced", unfenced)
    direct = with_strict_json(cut, "_unfenced", "_direct")
    inner = with_strict_json(
        direct.withColumn("_inner", F.when(F.col("_direct").isNull(), braced)), "_inner", "_second"
    )
    return inner.withColumn(target, F.coalesce("_direct", "_second")).drop(
        "_stripped", "_unfenced", "_direct", "_inner", "_second"
    )


def kind(v: Column) -> Column:
    """OBJECT, ARRAY, STRING, VOID (JSON null) ... of a variant; NULL if absent."""
    return F.regexp_extract(F.schema_of_variant(v), r"^(\w+)", 1)


def member(v: Column, name: str) -> Column:
    return F.try_variant_get(v, f"$.{name}", "variant")


def record_kinds(record: Column) -> Column:
    """The kind of the record and of each of its fields, as a struct. A list of
    strings only has the kind TEXTS."""

    def list_kind(name: str) -> Column:
        value = member(record, name)
        texts = F.forall(
            F.try_variant_get(value, "$", "array<variant>"),
            lambda e: F.coalesce(F.schema_of_variant(e), F.lit("VOID")) == "STRING",
        )
        return F.when(texts, F.lit("TEXTS")).otherwise(kind(value))

    single = [*REQUIRED_TEXT, *OPTIONAL_TEXT, "opportunity"]
    return F.struct(
        kind(record).alias("record"),
        *[kind(member(record, name)).alias(name) for name in single],
        *[list_kind(name).alias(name) for name in TEXT_LISTS],
    )


def record_fault(kinds: Column) -> Column:
    """Name of the first field that breaks the record's types, NULL for a valid
    record. Numbers are no strings; an explicit null is valid only where a
    missing value is."""
    fault = F.when(kinds["record"] != "OBJECT", F.lit("record"))
    for name in REQUIRED_TEXT:
        fault = fault.when(F.coalesce(kinds[name], F.lit("")) != "STRING", name)
    for name in OPTIONAL_TEXT:
        fault = fault.when(~kinds[name].isin("STRING", "VOID"), name)
    fault = fault.when(kinds["opportunity"] != "STRING", "opportunity")
    for name in TEXT_LISTS:
        fault = fault.when(kinds[name] != "TEXTS", name)
    return fault
