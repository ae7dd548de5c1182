"""Contracts over record tables: a table in, valid rows and rejected rows with reasons out.

A record is a JSON text. Rules are column expressions on its parsed form; nothing runs per row in
Python. Parsing keeps JSON types apart, so a quoted number is not a number where a rule is strict.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions import fixed_values as V
from tidewatch.functions.text import strip

TRUE_WORDS = ["true", "1", "t", "y", "yes", "on"]
FALSE_WORDS = ["false", "0", "f", "n", "no", "off"]


# --- text to record ------------------------------------------------------------------------------


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is named there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def parse_object(text: Column) -> Column:
    """The text as a VARIANT if it is one JSON object and nothing else, else null.

    The parser stops after the first value, so the text is wrapped together with its own digest
    after it: whatever follows the object would make the digest unreadable.
    """
    digest = F.sha1(text)
    wrapped = F.try_parse_json(
        F.concat(F.lit('{"doc":'), text, F.lit(',"end":"'), digest, F.lit('"}'))
    )

    def inside(wrapped: Column) -> Column:
        whole = F.try_variant_get(wrapped, "$.end", "string") == digest
        is_object = lambda doc: F.when(F.schema_of_variant(doc).startswith("OBJECT"), doc)
        return F.when(whole, once(F.try_variant_get(wrapped, "$.doc", "variant"), is_object))

    return once(wrapped, inside)


def without_fences(text: Column) -> Column:
    return strip(F.regexp_replace(text, "```(?:json|JSON)?", ""))


def recovered_text(text: Column) -> Column:
    """Small repairs, each on top of the one before: prose around the braces, commas before a
    closing bracket, single quotes where no double quote occurs, unquoted keys. A text that is cut
    off is not completed."""
    inner = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    commas = F.regexp_replace(inner, r",\s*([}\]])", "$1")
    quotes = once(commas, lambda c: F.when(~c.contains('"'), F.replace(c, F.lit("'"), F.lit('"'))).otherwise(c))
    return F.regexp_replace(quotes, r"([{,]\s*)([A-Za-z_][A-Za-z0-9_]*)\s*:", '$1"$2":')


# a string, ended or cut off; a mark; anything between
TOKENS = r'"[^"]*+"?|[{}\[\],:]|[^"{}\[\],:]++'
LITERAL = r"^(-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?|true|false|null)$"
# two code points that no text may hold stand for an escaped backslash and an escaped quote
BACKSLASH, QUOTE = "\ufdd0", "\ufdd1"


def completed_text(text: Column) -> Column:
    """An object that was cut off, closed again; null where its brackets do not match.

    Tokens are folded with the open brackets as a stack. Values without quotes get them, a string that was cut off is
    ended, a key without a value gets null, a key that was cut off goes; prose after the object goes. A number that was
    cut off cannot be told from a whole one. Texts with the two code points used for escapes give null."""
    begun = F.regexp_extract(text, r"(?s)\{.*", 0)
    quoted = once(begun, lambda b: F.when(~b.contains('"'), F.replace(b, F.lit("'"), F.lit('"'))).otherwise(b))
    hidden = F.replace(F.replace(quoted, F.lit("\\\\"), F.lit(BACKSLASH)), F.lit('\\"'), F.lit(QUOTE))
    # an escape that was cut off, and commas before a closing bracket
    whole = F.regexp_replace(F.regexp_replace(hidden, r"\\(u[0-9A-Fa-f]{0,3})?\z", ""), r",\s*([}\]])", "$1")
    hides = text.contains(BACKSLASH) | text.contains(QUOTE)
    return F.when(~hides, once(F.regexp_extract_all(whole, F.lit(TOKENS), F.lit(0)), _closed_tokens))


def _closed_tokens(tokens: Column) -> Column:
    def step(state: Column, token: Column) -> Column:
        stack, wants = state["stack"], state["wants"]
        opens, closes = token.isin("{", "["), token.isin("}", "]")
        after = (
            F.when(opens, F.concat(F.when(token == "{", "}").otherwise("]"), stack))
            .when(closes, F.substring(stack, F.lit(2), F.length(stack)))
            .otherwise(stack)
        )
        scalar = F.when(strip(token) == "", wants).when(wants == "key", "colon").otherwise("any")
        next_wanted = (
            F.when(token == "{", "key")
            .when(opens | closes, "any")
            .when(token == ":", F.when(wants == "colon", "value").otherwise(wants))
            .when(token == ",", F.when(stack.startswith("}"), "key").otherwise("any"))
            .otherwise(scalar)
        )
        moved = F.struct(
            after.alias("stack"), next_wanted.alias("wants"), (state["taken"] + 1).alias("taken"),
            (state["bad"] | (closes & ~stack.startswith(token))).alias("bad"),
        )
        return F.when((state["taken"] > 0) & (stack == ""), state).otherwise(moved)

    start = F.struct(F.lit("").alias("stack"), F.lit("any").alias("wants"), F.lit(0).alias("taken"), F.lit(False).alias("bad"))

    def written(token: Column) -> Column:
        bare = strip(token)
        as_is = token.startswith('"') | token.isin("{", "}", "[", "]", ",", ":") | (bare == "") | F.regexp_like(bare, F.lit(LITERAL))
        escaped = F.replace(F.regexp_replace(bare, r"[\x00-\x1F]", " "), F.lit("\\"), F.lit("\\\\"))
        return F.when(as_is, token).otherwise(F.concat(F.lit('"'), escaped, F.lit('"')))

    def closed(state: Column) -> Column:
        last = F.try_element_at(tokens, state["taken"])
        # a key that was cut off, and the blanks after it
        loose = F.when(state["wants"] == "colon", F.when(strip(last) == "", 2).otherwise(1)).otherwise(0)
        body = F.array_join(F.transform(F.slice(tokens, F.lit(1), state["taken"] - loose), written), "")
        cut = last.startswith('"') & ((F.length(last) == 1) | ~last.endswith('"'))
        ended = (
            F.when(state["wants"] == "colon", body)
            .when(state["wants"] == "value", F.concat(body, F.lit("null")))
            .when(cut, F.concat(body, F.lit('"')))
            .otherwise(body)
        )
        whole_again = F.concat(F.regexp_replace(ended, r",\s*\z", ""), state["stack"])
        shown = F.replace(F.replace(whole_again, F.lit(QUOTE), F.lit('\\"')), F.lit(BACKSLASH), F.lit("\\\\"))
        return F.when((state["taken"] > 0) & ~state["bad"], shown)

    return F.aggregate(tokens, start, step, closed)


def extract_object(text: Column, complete: bool = False) -> Column:
    """A JSON object out of messy text, or null: as it is, without the prose around it, repaired, and with ``complete``
    also closed again where it was cut off."""

    def ways(clean: Column) -> Column:
        # a parse that fails is dear: none of an empty text, of one without its braces, or of one that failed already
        whole = F.when(clean.startswith("{") & clean.endswith("}"), parse_object(clean))
        inner = F.regexp_extract(clean, r"(?s)\{.*\}", 0)
        within = once(inner, lambda t: F.when((t != "") & (t != clean), parse_object(t)))
        repaired = once(recovered_text(clean), lambda t: F.when((t != "") & (t != inner), parse_object(t)))
        closed = [once(completed_text(clean), parse_object)] if complete else []
        return F.coalesce(whole, within, repaired, *closed)

    return once(without_fences(text), ways)


# --- rules ---------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Field:
    """One field of a record. ``lax`` also takes numbers and booleans written as text."""

    name: str
    kind: str  # string, number, boolean, strings, time, record
    required: bool = True
    nullable: bool = False
    lax: bool = False
    at_least: float | None = None
    at_most: float | None = None
    above: float | None = None
    min_length: int | None = None
    max_length: int | None = None
    stripped_min: int | None = None
    #: the record holds the text without blanks around it
    stripped: bool = False
    choices: Sequence[str] | None = None
    record: "Contract | None" = None


@dataclass(frozen=True)
class Contract:
    """Fields, whether other keys are refused, and rules across fields: name -> function of a
    reader (field name -> column) that is true where the rule is broken."""

    fields: Sequence[Field]
    closed: bool = True
    across: Mapping[str, object] = field(default_factory=dict)


NUMBERS = "^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*)$"


def _typed_value(variant: Column, kind: str) -> Column:
    """Value of a field's VARIANT, null where it has no such value."""
    if kind == "number":
        return F.try_variant_get(variant, "$", "double")
    if kind == "strings":
        return F.try_variant_get(variant, "$", "array<string>")
    if kind == "record":
        return variant
    text = F.try_variant_get(variant, "$", "string")
    if kind == "boolean":
        word = F.lower(text)
        return F.when(word.isin(TRUE_WORDS), True).when(word.isin(FALSE_WORDS), False)
    if kind == "time":
        return text.try_cast("timestamp")
    return text


def read_field(doc: Column, f: Field) -> Column:
    return _typed_value(F.try_variant_get(doc, f"$.{f.name}", "variant"), f.kind)


def _field_rules(f: Field, kind: Column, value: Column) -> list[tuple[str, Column]]:
    """``(name, broken)`` of one field, from the JSON type it came with and its typed value."""
    null = kind == "VOID"
    there = kind.isNotNull() & ~null
    fits = {
        "string": kind == "STRING",
        "number": F.regexp_like(kind, F.lit(NUMBERS)),
        "boolean": kind == "BOOLEAN",
        "strings": kind.isin("ARRAY<STRING>", "ARRAY<VOID>"),
        "time": (kind == "STRING") & value.isNotNull(),
        "record": kind.startswith("OBJECT"),
    }[f.kind]
    if f.lax and f.kind in ("number", "boolean"):
        fits = fits | (F.regexp_like(kind, F.lit(NUMBERS + "|^STRING$|^BOOLEAN$")) & value.isNotNull())
    rules: list[tuple[str, Column]] = []
    if f.required:
        rules.append((f"missing:{f.name}", kind.isNull()))
    rules.append((f"type:{f.name}", (there & ~fits) if f.nullable else (null | (there & ~fits))))
    usable = there & fits
    limits = [
        value < f.at_least if f.at_least is not None else None,
        value > f.at_most if f.at_most is not None else None,
        value <= f.above if f.above is not None else None,
    ]
    outside = [limit for limit in limits if limit is not None]
    if outside:
        beyond = F.isnan(value)
        for limit in outside:
            beyond = beyond | limit
        rules.append((f"range:{f.name}", usable & beyond))
    if f.kind in ("string", "strings"):
        size = F.length(value) if f.kind == "string" else F.size(value)
        if f.min_length is not None:
            rules.append((f"short:{f.name}", usable & (size < f.min_length)))
        if f.max_length is not None:
            rules.append((f"long:{f.name}", usable & (size > f.max_length)))
        if f.stripped_min is not None:
            rules.append((f"blank:{f.name}", usable & (F.length(strip(value)) < f.stripped_min)))
    if f.choices is not None:
        rules.append((f"choice:{f.name}", usable & ~value.isin(list(f.choices))))
    return rules


def _with_rules(df: DataFrame, doc: str, contract: Contract, prefix: str, tag: str) -> tuple[DataFrame, list[tuple[str, Column]]]:
    """Adds columns for each field's VARIANT, type and value, so that each is taken out of the record
    once however many rules look at it; returns the rules on those columns."""
    spots = {f.name: i for i, f in enumerate(contract.fields)}
    column = lambda what, name: F.col(f"{tag}{what}{spots[name]}")
    df = df.withColumns({f"{tag}v{i}": F.try_variant_get(doc, f"$.{n}", "variant") for n, i in spots.items()})
    df = df.withColumns({f"{tag}k{i}": F.schema_of_variant(f"{tag}v{i}") for i in spots.values()})
    df = df.withColumns({f"{tag}x{spots[f.name]}": _typed_value(column("v", f.name), f.kind) for f in contract.fields})
    rules: list[tuple[str, Column]] = []
    if contract.closed:
        keys = F.map_keys(F.try_variant_get(doc, "$", "map<string,variant>"))
        rules.append(("extra_keys", F.size(F.array_except(keys, F.array(*[F.lit(n) for n in spots]))) > 0))
    for f in contract.fields:
        rules.extend(_field_rules(f, column("k", f.name), column("x", f.name)))
    for name, rule in contract.across.items():
        rules.append((name, rule(lambda n: column("x", n))))
    rules = [(prefix + name, broken) for name, broken in rules]
    for f in contract.fields:
        if f.record is not None:
            is_object = column("k", f.name).startswith("OBJECT")
            df, inner = _with_rules(df, f"{tag}v{spots[f.name]}", f.record, f"{prefix}{f.name}.", f"{tag}{spots[f.name]}_")
            rules.extend((name, is_object & broken) for name, broken in inner)
    return df, rules


def check(df: DataFrame, raw: str, contract: Contract, repair: bool = False) -> DataFrame:
    """Adds ``doc`` (VARIANT or null) and ``violations``, the names of the broken rules in order; a
    text that is no JSON object has the one violation ``not_an_object``."""
    text = F.col(raw)
    parsed = df.withColumn("doc", extract_object(text) if repair else parse_object(text))
    staged, rules = _with_rules(parsed, "doc", contract, "", "_r")
    marks = F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules]))
    found = F.when(F.col("doc").isNull(), F.array(F.lit("not_an_object"))).otherwise(marks)
    return staged.select(*parsed.columns, found.alias("violations"))


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejected rows with their reasons: together exactly the rows given."""
    fine = F.size("violations") == 0
    return checked.filter(fine).drop("violations"), checked.filter(~fine)


def typed(doc: Column, contract: Contract, defaults: Mapping[str, Column] | None = None) -> Column:
    """The record as a struct of typed values, defaults for absent optional fields."""
    defaults = defaults or {}
    fields = []
    for f in contract.fields:
        value = strip(read_field(doc, f)) if f.stripped else read_field(doc, f)
        if f.name in defaults:
            value = F.coalesce(value, defaults[f.name])
        fields.append(value.alias(f.name))
    return F.struct(*fields)


# --- the record contracts ------------------------------------------------------------------------


def _text(name, low=1, high=None, **more):
    return Field(name, "string", min_length=low, max_length=high, **more)


def _share(name, lax=True):
    return Field(name, "number", lax=lax, at_least=0.0, at_most=1.0)


_STATUS = Field("agent_status", "string", required=False, choices=V.AGENT_STATUSES)
_TIME = Field("timestamp", "string", required=False)
_DISPOSITION = dict(kind="string", choices=V.DISPOSITIONS)

RISK_REQUEST = Contract(
    [
        Field("account_id", "string"),
        Field("arr", "number", above=0.0),
        Field("top_3_shap_drivers", "strings", min_length=1, max_length=3),
        _share("churn_probability", lax=False),
    ]
)
DECISION = Contract(
    [
        Field("thread_id", "string"),
        Field("approved", "boolean"),
        Field("human_feedback", "string", required=False, nullable=True),
    ]
)
TELEMETRY_METRICS = [
    "cpu_pct", "memory_pct", "latency_p50_ms", "latency_p95_ms", "latency_p99_ms",
    "error_rate_pct", "queue_depth", "thread_count",
]
TELEMETRY = Contract(
    [
        Field("service_name", "string"),
        Field("timestamp", "time"),
        *[Field(m, "number", lax=True) for m in TELEMETRY_METRICS],
    ],
    closed=False,
)
PROMPT = Contract([_text("text", 1, 8000, stripped_min=1)], closed=False)
TRIAGE = Contract(
    [
        _text("prompt_id"),
        Field("attack_category", "string", choices=V.CATEGORIES),
        Field("classifier_risk_tier", "string", choices=V.RISK_TIERS),
        Field("disposition", **_DISPOSITION),
        _text("justification", 10, 1000, stripped_min=10, stripped=True),
        _share("triage_confidence"),
        Field("requires_sanitization", "boolean", lax=True),
        Field("requires_judge_review", "boolean", lax=True),
        _STATUS,
        _TIME,
    ],
    across={
        "low_tier_cannot_block": lambda f: (f("classifier_risk_tier") == "low")
        & f("disposition").isin("block", "escalate")
    },
)
SANITIZER = Contract(
    [
        _text("prompt_id"),
        _text("original_prompt"),
        _text("sanitized_prompt"),
        Field("tokens_removed", "strings", required=False),
        _share("sanitization_confidence"),
        Field("residual_risk_detected", "boolean", lax=True),
        _STATUS,
        _TIME,
    ],
    across={
        "unchanged_without_flag": lambda f: (strip(f("sanitized_prompt")) == strip(f("original_prompt")))
        & ~f("residual_risk_detected")
    },
)
JUDGE = Contract(
    [
        _text("prompt_id"),
        Field("triage_disposition_reviewed", **_DISPOSITION),
        Field("judge_disposition", **_DISPOSITION),
        Field("agrees_with_triage", "boolean", lax=True),
        _text("judge_reasoning", 10, 1000),
        _share("judge_confidence"),
        Field("model_used", "string"),
        _STATUS,
        _TIME,
    ],
    across={
        "agreement_flag_lies": lambda f: (f("triage_disposition_reviewed") == f("judge_disposition"))
        != f("agrees_with_triage")
    },
)
ESCALATION = Contract(
    [
        _text("incident_id"),
        _text("prompt_id"),
        _text("original_prompt"),
        Field("attack_category", "string", choices=V.CATEGORIES),
        Field("classifier_risk_tier", "string", choices=V.RISK_TIERS),
        Field("triage_disposition", required=False, nullable=True, **_DISPOSITION),
        Field("judge_disposition", required=False, nullable=True, **_DISPOSITION),
        Field("agents_disagreed", "boolean", lax=True),
        _text("escalation_reason", 10, 2000),
        Field("severity", "string", choices=V.RISK_TIERS),
        Field("recommended_action", **_DISPOSITION),
        Field("notify_slack", "boolean", required=False, lax=True),
        _STATUS,
        _TIME,
    ],
    across={"incident_prefix": lambda f: ~f("incident_id").startswith("INC-")},
)
TRACE = Contract(
    [
        _text("prompt_id"),
        Field("triage", "record", required=False, nullable=True, record=TRIAGE),
        Field("sanitizer", "record", required=False, nullable=True, record=SANITIZER),
        Field("judge", "record", required=False, nullable=True, record=JUDGE),
        Field("escalation", "record", required=False, nullable=True, record=ESCALATION),
        Field("final_disposition", **_DISPOSITION),
        Field("pipeline_status", "string", required=False, choices=V.AGENT_STATUSES),
        Field("total_latency_ms", "number", required=False, nullable=True, lax=True, at_least=0.0),
        _TIME,
    ]
)


def cast_violations(df: DataFrame, casts: Mapping[str, str], name: str = "violations") -> DataFrame:
    """For a table of strings: the columns whose value does not cast."""
    marks = [
        F.when(F.col(c).isNull() | F.col(c).try_cast(t).isNull(), F.lit(f"type:{c}")) for c, t in casts.items()
    ]
    return df.withColumn(name, F.array_compact(F.array(*marks)))


# --- fail-closed substitutes ---------------------------------------------------------------------


def triage_or_escalation(triage: Column, is_valid: Column, prompt_id: Column, label: Column, reason: Column) -> Column:
    """A triage record that failed becomes the most conservative one."""
    because = F.concat(
        F.lit(V.FAIL_CLOSED_BEGIN), reason, F.lit(V.TRIAGE_FAIL_CLOSED_END),
    )
    fallback = F.struct(
        prompt_id.alias("prompt_id"), label.alias("attack_category"), F.lit("high").alias("classifier_risk_tier"),
        F.lit("escalate").alias("disposition"), because.alias("justification"), F.lit(0.0).alias("triage_confidence"),
        F.lit(False).alias("requires_sanitization"), F.lit(True).alias("requires_judge_review"),
        F.lit("validation_failed").alias("agent_status"), F.lit(None).cast("string").alias("timestamp"),
    )
    return F.when(is_valid, triage).otherwise(fallback)


def sanitizer_or_unchanged(sanitizer: Column, is_valid: Column, prompt_id: Column, prompt: Column) -> Column:
    """A sanitizer record that failed leaves the prompt as it is and flags residual risk."""
    fallback = F.struct(
        prompt_id.alias("prompt_id"), prompt.alias("original_prompt"), prompt.alias("sanitized_prompt"),
        F.array().cast("array<string>").alias("tokens_removed"), F.lit(0.0).alias("sanitization_confidence"),
        F.lit(True).alias("residual_risk_detected"), F.lit("validation_failed").alias("agent_status"),
        F.lit(None).cast("string").alias("timestamp"),
    )
    return F.when(is_valid, sanitizer).otherwise(fallback)


def judge_or_escalation(
    judge: Column, is_valid: Column, prompt_id: Column, triage_disposition: Column, reason: Column, model: str
) -> Column:
    """A judge record that failed escalates; its agreement flag is computed, not assumed."""
    because = F.concat(
        F.lit(V.FAIL_CLOSED_BEGIN), reason, F.lit(V.JUDGE_FAIL_CLOSED_END),
    )
    fallback = F.struct(
        prompt_id.alias("prompt_id"), triage_disposition.alias("triage_disposition_reviewed"),
        F.lit("escalate").alias("judge_disposition"), (triage_disposition == "escalate").alias("agrees_with_triage"),
        because.alias("judge_reasoning"), F.lit(0.0).alias("judge_confidence"), F.lit(model).alias("model_used"),
        F.lit("validation_failed").alias("agent_status"), F.lit(None).cast("string").alias("timestamp"),
    )
    return F.when(is_valid, judge).otherwise(fallback)
