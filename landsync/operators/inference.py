"""Preparing text for a language model and reading its landed replies.

No model is called here: the output of the first half is a table of prompts,
the input of the second a table of replies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landsync import schemas
from landsync.functions import reply as R
from landsync.functions.text import blank_to_null, col
from landsync.operators.filters import document_long_enough

# Size cap of a document, the mark left by a cut, context defaults.
MAX_CHARS = 50_000
CUT_MARK = "\n\n[... content truncated ...]"
CONTEXT_DEFAULTS = {
    "plan_name": "Unknown",
    "description": "Not available",
    "eligible_age": "Not specified",
    "provider_name": "Unknown",
}
CLASS_TEXT_CHARS = 1000
#: Characters of a part of a long document, and how many of them the next part repeats.
PART_CHARS, PART_OVERLAP = MAX_CHARS, 1_000

_FIELD_LINES = [(f, "text or null") for f in schemas.TEXT_FIELDS]
_FIELD_LINES += [(f, "amount in RM as a number, or null") for f in schemas.MONEY_FIELDS]
_FIELD_LINES += [("co_payment_percentage", "number from 0 to 100, or null")]
_FIELD_LINES += [(f, "whole years, or null") for f in schemas.AGE_FIELDS]
_FIELD_LINES += [(f, "true or false") for f in schemas.COVERAGE_FIELDS]
_FIELD_LINES += [(f, "list of texts") for f in schemas.LIST_FIELDS]

PROMPT_HEAD = (
    "Read the insurance document below and answer with one JSON object and nothing else.\n"
    "Use only what the document states. Fields:\n"
    + "\n".join(f"- {name}: {kind}" for name, kind in _FIELD_LINES)
    + "\n\nDocument:\n"
)
PROMPT_CONTEXT = [
    ("\n\nFrom the web page:\n- Plan: ", "plan_name"),
    ("\n- Description: ", "description"),
    ("\n- Eligible age: ", "eligible_age"),
    ("\n- Provider: ", "provider_name"),
]
CLASS_HEAD = ("Is this plan MEDICAL (it pays hospital bills) or CRITICAL_ILLNESS "
              "(it pays a lump sum on diagnosis)? Answer with that one word.\nPlan: ")


def cut_text(text: Column | str, max_chars: int | None = None) -> Column:
    """The text, whole unless ``max_chars`` is given; then a longer one is cut there
    and gets the cut mark."""
    text = col(text)
    if max_chars is None:
        return text
    return F.when(F.length(text) > max_chars,
                  F.concat(F.substring(text, 1, max_chars), F.lit(CUT_MARK))).otherwise(text)


def prompts(documents: DataFrame, text: str = "text", max_chars: int | None = None,
            min_chars: int = 100) -> DataFrame:
    """Documents long enough to analyse, with ``prompt``; context columns may be
    absent or null and then take their default. A model with a narrow window may
    need ``max_chars=MAX_CHARS``."""
    pieces: list[Column] = [F.lit(PROMPT_HEAD), cut_text(text, max_chars)]
    for label, name in PROMPT_CONTEXT:
        default = F.lit(CONTEXT_DEFAULTS[name])
        value = F.coalesce(F.col(name), default) if name in documents.columns else default
        pieces += [F.lit(label), value]
    return (documents.filter(document_long_enough(text, min_chars))
            .withColumn("prompt", F.concat(*pieces)))


def document_parts(documents: DataFrame, text: str = "text", part_chars: int = PART_CHARS,
                   overlap: int = PART_OVERLAP) -> DataFrame:
    """One row per part of a document: ``part`` from 0, ``n_parts``, and the part in ``text``.

    Parts overlap, so what stands across a border (up to ``overlap`` characters) is
    whole in one of them; nothing is cut. An empty text is one empty part, a null text
    one null part. Columns ``part`` and ``n_parts`` are replaced.
    """
    if not 0 <= overlap < part_chars:
        raise ValueError("overlap must be less than a part")
    step = part_chars - overlap
    n = F.greatest(F.ceil((F.length(text) - overlap) / step), F.lit(1)).cast("int")
    parts = F.transform(F.sequence(F.lit(0), F.col("n_parts") - 1),
                        lambda i: F.substring(F.col(text), i * step + 1, F.lit(part_chars)))
    others = [c for c in documents.columns if c not in (text, "part", "n_parts")]
    # the outer form, as the plain one makes Spark work out the parts twice for its filter
    return (documents.drop("part", "n_parts").withColumn("n_parts", F.coalesce(n, F.lit(1)))
            .select(*others, "n_parts", F.posexplode_outer(parts).alias("part", text)))


def part_prompts(documents: DataFrame, text: str = "text", part_chars: int = PART_CHARS,
                 overlap: int = PART_OVERLAP, min_chars: int = 100) -> DataFrame:
    """A prompt for every part of each document that is long enough as a whole."""
    long = documents.filter(document_long_enough(text, min_chars))
    return prompts(document_parts(long, text, part_chars, overlap), text, min_chars=0)


def fold_replies(parsed: DataFrame, key: str = "doc_id", part: str = "part") -> DataFrame:
    """One record per document from the parsed replies to its parts.

    Texts, amounts, the percentage and ages: the value of the first part that states one.
    Coverage flags: true if any part says so, else false if any does. Lists: entries of
    all parts in order, each once; null if no part has a list. ``n_replies`` counts the
    rows, those with nothing in them too. Two replies to one part count as one after the
    other, in the order of their values. Rows without a document form no record.
    """
    def first(name: str) -> Column:
        return F.min(F.when(F.col(name).isNotNull(), F.struct(part, name)))[name]

    def entries(name: str) -> Column:
        rows = F.array_sort(F.collect_list(F.when(F.col(name).isNotNull(), F.struct(part, name))))
        merged = F.array_distinct(F.flatten(F.transform(rows, lambda r: r[name])))
        return F.when(F.count(name) > 0, merged)

    scalars = [*schemas.TEXT_FIELDS, *schemas.MONEY_FIELDS, "co_payment_percentage", *schemas.AGE_FIELDS]
    return parsed.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("n_replies"),
        *(first(f).alias(f) for f in scalars),
        *(F.max(f).alias(f) for f in schemas.COVERAGE_FIELDS),
        *(entries(f).alias(f) for f in schemas.LIST_FIELDS))


def class_text(description: Column | str, benefits: Column | str,
               max_chars: int | None = None) -> Column:
    """Description and benefits joined by a space, for classification; cut only if
    ``max_chars`` (such as CLASS_TEXT_CHARS) is given."""
    both = F.concat(F.coalesce(col(description), F.lit("")), F.lit(" "),
                    F.coalesce(col(benefits), F.lit("")))
    return both if max_chars is None else F.substring(both, 1, max_chars)


def class_prompts(plans: DataFrame, name: str = "plan_name", description: str = "description",
                  benefits: str = "benefits") -> DataFrame:
    return plans.withColumn("prompt", F.concat(
        F.lit(CLASS_HEAD), F.col(name), F.lit("\nText: "), class_text(description, benefits)))


def parse_replies(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """Replies with the 20 typed fields; text that is no JSON gives nulls."""
    parsed = replies.withColumn("_reply", F.try_parse_json(F.col(reply)))
    v = F.col("_reply")
    out = {f: R.text(v, f) for f in schemas.TEXT_FIELDS}
    out.update({f: R.number(v, f) for f in (*schemas.MONEY_FIELDS, "co_payment_percentage")})
    out.update({f: R.age(v, f) for f in schemas.AGE_FIELDS})
    out.update({f: R.flag(v, f) for f in schemas.COVERAGE_FIELDS})
    out.update({f: R.strings(v, f) for f in schemas.LIST_FIELDS})
    return parsed.withColumns(out).drop("_reply")


def join_page_texts(pages: DataFrame, key: str = "doc_id", order: str = "page_no",
                    text: str = "text", separator: str = "\n\n") -> DataFrame:
    """One text per document: non-empty pages in page order.

    The pages of one document must fit one value, as the text itself does.
    """
    # Pages without a document belong together no more than to any other.
    kept = pages.filter((F.length(F.col(text)) > 0) & F.col(key).isNotNull())
    rows = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(text))))
    return (kept.groupBy(key).agg(rows.alias("_pages"))
            .select(key, F.array_join(F.transform("_pages", lambda p: p[text]), separator)
                    .alias(text)))


def analysis_input(page_facts: DataFrame, brochures: DataFrame) -> DataFrame:
    """Text to analyse per product page: the brochure where a link was found (and
    its text landed), the page text only where there was no link and it is long.

    ``brochures`` has ``brochure_url`` and ``text``.
    """
    # Pages without a link get a key of their own, or they would all meet in one task.
    key = F.coalesce(F.col("brochure_url"), F.concat(F.lit("none:"), F.col("url")))
    landed = brochures.select(F.col("brochure_url").alias("_link"), F.col("text").alias("_brochure"))
    keyed = page_facts.withColumn("_key", key)
    joined = keyed.join(landed, F.col("_key") == F.col("_link"), "left")
    own = F.when(F.col("brochure_url").isNull() & (F.length("page_text") > 500),
                 F.col("page_text"))
    text = F.when(F.col("brochure_url").isNotNull(), blank_to_null(F.col("_brochure")))
    return (joined.withColumn("text", F.coalesce(text, own))
            .drop("_brochure", "_link", "_key"))
