"""Summary stage: requests, recent events, prompts, generation, reply checks."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sirenlog.functions import strict_json as sj
from sirenlog.functions.text import is_blank, or_default, shown
from sirenlog.functions.timestamps import iso_millis
from sirenlog.operators.numbering import numbered, part_offsets, parts_of

# Fixed values.
DEFAULT_LIMIT = 20
CONFIDENCE = ("LOW", "MEDIUM", "HIGH")
LIST_LENGTH = 3
# The contract of a reply: field, kind, and what is asked of the field.  The prompt's rules,
# the decoded columns and the checks all come from it.
TEXT, CHOICE, LIST = "text", "choice", "list"
REPLY_CONTRACT = (
    ("summary", TEXT, "2 to 4 sentences, fewer than 90 words, no markdown."),
    ("customer_impact", TEXT, "1 or 2 sentences."),
    ("likely_root_cause", TEXT, '"Unknown based on current evidence" when unclear.'),
    ("confidence", CHOICE, f"{', '.join(CONFIDENCE[:-1])} or {CONFIDENCE[-1]}, by strength of evidence."),
    ("next_actions", LIST, f"exactly {LIST_LENGTH} specific imperative items."),
    ("signals", LIST, f"exactly {LIST_LENGTH} concrete observations from the context."),
)
SUMMARY_FIELDS = tuple(name for name, _, _ in REPLY_CONTRACT)
GRAPHQL_FIELDS = ("summary", "customerImpact", "likelyRootCause", "confidence", "nextActions", "signals")
NO_EVENTS = "(none)"
NO_HEALTH = "(not provided)"

MAX_LONG = 2**63 - 1


def newest_first() -> list[Column]:
    return [F.desc("event_timestamp"), F.asc("event_id")]


def effective_limit() -> Column:
    """An omitted limit is 20; null and NaN take nothing; fractions are cut; negative drops the oldest."""
    return (
        F.when(~F.col("limit_given"), F.lit(DEFAULT_LIMIT))
        .when(F.col("limit").isNull() | F.isnan("limit"), F.lit(0))
        .when(F.col("limit") >= float(MAX_LONG), F.lit(MAX_LONG))
        .when(F.col("limit") <= -float(MAX_LONG), F.lit(-MAX_LONG))
        .otherwise(F.col("limit").try_cast("bigint"))
        .cast("bigint")
    )


def asked_limits(requests: DataFrame) -> DataFrame:
    return requests.filter(F.coalesce("incident_id", F.lit("")) != "").select(
        "request_id", "incident_id", effective_limit().alias("take")
    )


def kept_of() -> Column:
    """How many of an incident's ``total`` events a request keeps."""
    return F.when(F.col("take") < 0, F.greatest(F.col("total") + F.col("take"), F.lit(0))).otherwise(
        F.least("take", "total"))


def recent_events(timeline: DataFrame, requests: DataFrame) -> DataFrame:
    """Per request its newest events, with their 1-based ``position``.

    One way for every limit.  The requested incidents' events are numbered once
    per incident; a request keeps the first of them, as many as its limit and
    the incident's total say.  Parts that lie wholly beyond the most that any
    request keeps are dropped before they are ranked.
    """
    asked = asked_limits(requests)
    group, order = ["incident_id"], newest_first()
    wanted = asked.select("incident_id").distinct()
    parts = parts_of(timeline.join(wanted, "incident_id", "left_semi"), group, order)
    offsets = part_offsets(parts, group)
    totals = offsets.groupBy("incident_id").agg(F.max("total").alias("total"))
    kept = asked.join(totals, "incident_id").select("request_id", "incident_id", kept_of().alias("kept")).filter("kept > 0")
    most = kept.groupBy("incident_id").agg(F.max("kept").alias("most"))
    needed = offsets.join(most, "incident_id").filter("before < most")
    ranked = numbered(parts, needed, group, order, "position").filter("position <= most").select(
        "incident_id", "position", "event_id", "event_type", "message", "event_timestamp")
    return ranked.join(kept, "incident_id").filter("position <= kept").select(
        "request_id", "position", "event_id", "event_type", "message", "event_timestamp")


def request_status(requests: DataFrame, timeline: DataFrame) -> DataFrame:
    """``INVALID`` without an incident id, ``NOT_FOUND`` without events, else ``OK``; from counts alone."""
    asked = asked_limits(requests)
    totals = timeline.join(asked.select("incident_id").distinct(), "incident_id", "left_semi").groupBy(
        "incident_id").agg(F.count(F.lit(1)).alias("total"))
    counts = asked.join(totals, "incident_id").select("request_id", kept_of().alias("events"))
    return requests.join(counts, "request_id", "left").select(
        *requests.columns,
        F.coalesce("events", F.lit(0)).cast("bigint").alias("events"),
        F.when(F.coalesce("incident_id", F.lit("")) == "", "INVALID")
        .when(F.coalesce("events", F.lit(0)) == 0, "NOT_FOUND")
        .otherwise("OK").alias("status"),
    )


def not_found(requests: DataFrame, timeline: DataFrame) -> DataFrame:
    """The requests that have no event to tell of."""
    return request_status(requests, timeline).filter(F.col("status") != "OK").select(*requests.columns)


def _event_line() -> Column:
    return F.concat(
        F.col("position").cast("string"), F.lit(". "), shown(iso_millis(F.col("event_timestamp"))),
        F.lit(" - "), shown(F.col("event_type")), F.lit(" - "), shown(F.col("message")),
    )


def _health_line() -> Column:
    return F.concat(
        F.lit("- "), shown(F.col("service_name")), F.lit(": "), shown(F.col("status")),
        F.lit(" (severity="), shown(F.col("severity")), F.lit(") — "), shown(F.col("message")),
        F.lit(" @ "), shown(iso_millis(F.col("last_updated"))),
    )


def _joined_lines(order: Column, line: Column) -> Column:
    rows = F.array_sort(F.collect_list(F.struct(order.alias("order"), line.alias("line"))))
    return F.array_join(F.transform(rows, lambda r: r["line"]), "\n")


def summary_context(requests: DataFrame, recent: DataFrame, health: DataFrame) -> DataFrame:
    """Requests that have events, with their event lines and the organisation's health lines.

    A text holds what its request asked for: at most ``limit`` event lines, and
    one line per service of one organisation.  The organisation is the
    requested one, whether or not the incident belongs to it.
    """
    event_text = recent.groupBy("request_id").agg(
        _joined_lines(F.col("position"), _event_line()).alias("events_text"),
        F.count(F.lit(1)).alias("events"),
    )
    named = requests.filter(F.col("org_id").isNotNull() & (F.col("org_id") != ""))
    wanted = health.join(named.select("org_id").distinct(), "org_id", "left_semi")
    health_text = wanted.groupBy("org_id").agg(
        _joined_lines(F.col("service_name"), _health_line()).alias("health_text"),
        F.count(F.lit(1)).alias("services"),
    )
    told = requests.select("request_id", "incident_id", "org_id").join(event_text, "request_id")
    # Requests without an organisation have no key to join on; left in, they would all meet in one task.
    has_org = F.coalesce("org_id", F.lit("")) != ""
    with_health = told.filter(has_org).join(health_text, "org_id", "left")
    return (
        with_health.unionByName(told.filter(~has_org), allowMissingColumns=True)
        .select(
            "request_id", "incident_id", "org_id", "events", F.coalesce("services", F.lit(0)).alias("services"),
            or_default(F.col("events_text"), NO_EVENTS).alias("events_text"),
            or_default(F.col("health_text"), NO_HEALTH).alias("health_text"),
        )
    )


PROMPT_HEAD = """You assist on-call engineers of an incident platform.
Summarise the production incident below. State only what the input supports, and name weak or conflicting evidence.

Rules for the reply, which is one JSON object and nothing else:
""" + "".join(f"- {name}: {rule}\n" for name, _, rule in REPLY_CONTRACT) + "\nContext\n"
PROMPT_TASK = "\n\nTask: write the JSON summary of this incident."


def summary_prompts(context: DataFrame) -> DataFrame:
    return context.select(
        "request_id", "incident_id",
        F.concat(
            F.lit(PROMPT_HEAD),
            F.lit("Incident ID: "), F.col("incident_id"),
            F.lit("\nOrg ID: "), or_default(F.col("org_id"), "unknown"),
            F.lit("\n\nRecent events, newest first:\n"), F.col("events_text"),
            F.lit("\n\nService health of the organisation:\n"), F.col("health_text"),
            F.lit(PROMPT_TASK),
        ).alias("prompt"),
    )


Generator = Callable[[Sequence[str]], Sequence[str]]


def offline_generator() -> Generator:
    """A deterministic stand-in for a hosted model, for tests and dry runs."""

    def reply(prompt: str) -> str:
        lines = prompt.split("\n")
        incident = next(x for x in lines if x.startswith("Incident ID: "))[len("Incident ID: "):]
        start = lines.index("Recent events, newest first:") + 1
        stop = lines.index("Service health of the organisation:")
        latest = lines[start]
        degraded = sum(1 for x in lines[stop + 1:] if ": DEGRADED (severity=" in x)
        return json.dumps(
            {
                "summary": f"Incident {incident}: latest event {latest}",
                "customer_impact": "Unknown",
                "likely_root_cause": "Unknown based on current evidence",
                "confidence": "LOW",
                "next_actions": ["Review the timeline", "Check service health", "Update the incident"],
                "signals": [f"event lines: {stop - 1 - start}", f"degraded services: {degraded}", latest],
            }
        )

    return lambda prompts: [reply(p) for p in prompts]


def generate_summaries(
    prompts: DataFrame, make_generator: Callable[[], Generator] = offline_generator, parallelism: int | None = None,
    batch_size: int = 64,
) -> DataFrame:
    """Run a caller's generator over the prompts; what fails is that request's ``error``.

    ``make_generator`` is called once per partition and so can open a client;
    the generator gets up to ``batch_size`` prompts.  When it fails on a batch,
    the batch's prompts are tried one by one, so that a bad prompt costs no
    other request its reply.  An empty reply is an error too.  ``parallelism``
    sets the number of partitions, as prompts are few and replies slow.
    """
    if parallelism:
        prompts = prompts.repartition(parallelism, "request_id")

    def answered(generate: Generator, texts: list[str]) -> list[tuple[str | None, str | None]]:
        try:
            replies = list(generate(texts))
            if len(replies) != len(texts):
                raise ValueError(f"{len(replies)} replies to {len(texts)} prompts")
            return [(reply or None, None if reply else "empty reply") for reply in replies]
        except Exception as error:  # whatever a client raises
            if len(texts) == 1:
                return [(None, f"{type(error).__name__}: {error}")]
            return [answered(generate, [text])[0] for text in texts]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        generate = make_generator()
        for batch in batches:
            for start in range(0, len(batch), batch_size):
                part = batch.iloc[start:start + batch_size]
                reply, error = zip(*answered(generate, part["prompt"].tolist()))
                yield part[["request_id", "incident_id"]].assign(reply=list(reply), error=list(error))

    return prompts.mapInPandas(run, "request_id string, incident_id string, reply string, error string")


def parse_summaries(replies: DataFrame, reply: str = "reply") -> DataFrame:
    """Decode replies into the six fields; ``decoded`` tells whether the text was JSON at all."""
    out = sj.JsonObject(reply, SUMMARY_FIELDS)
    decoded = out.attach(replies).selectExpr(
        *replies.columns,
        f"{out.is_valid()} AS decoded",
        *[
            f"CASE WHEN {sj.is_array(out.kind(name))} THEN from_json({out.raw(name)}, 'array<string>') END AS {name}"
            if kind == LIST else f"{out.string(name)} AS {name}"
            for name, kind, _ in REPLY_CONTRACT
        ],
    )
    return sj.evaluated_once(decoded)


def graphql_summary(parsed: DataFrame) -> DataFrame:
    """The decoded summary under its camel-case names."""
    return parsed.select(
        F.col("incident_id").alias("incidentId"),
        *[F.col(snake).alias(camel) for snake, camel in zip(SUMMARY_FIELDS, GRAPHQL_FIELDS)],
    )


def rest_summary(parsed: DataFrame) -> DataFrame:
    """The decoded summary merged flat with ``ok`` and the incident id."""
    return parsed.select(F.lit(True).alias("ok"), F.col("incident_id").alias("incidentId"), *SUMMARY_FIELDS)


def validate_replies(replies: DataFrame, shape: str = "summary", reply: str = "reply") -> DataFrame:
    """Add ``errors``, an array of texts that is empty for a valid reply.

    ``summary`` checks three texts for blankness; ``rest`` wants ``ok`` and the
    incident id too, ``graphql`` the id and camel-case names, and both check
    only the first text.  Missing fields are reported alone.
    """
    if shape not in ("summary", "rest", "graphql"):
        raise ValueError("shape must be 'summary', 'rest' or 'graphql'")
    names = GRAPHQL_FIELDS if shape == "graphql" else SUMMARY_FIELDS
    outer = {"summary": (), "rest": ("ok", "incidentId"), "graphql": ("incidentId",)}[shape]
    out = sj.JsonObject(reply, (*outer, *names))
    of_kind = lambda wanted: [n for n, (_, kind, _) in zip(names, REPLY_CONTRACT) if kind == wanted]
    checked_texts = of_kind(TEXT) if shape == "summary" else of_kind(TEXT)[:1]
    [confidence], lists = of_kind(CHOICE), of_kind(LIST)

    def got(name: str) -> str:
        return sj.as_json(out.kind(name), out.raw(name))

    missing = [f"CASE WHEN {out.kind(n)} IS NULL THEN 'missing field: {n}' END" for n in out.fields]
    problems = []
    if shape == "rest":
        problems.append(
            f"CASE WHEN {out.kind('ok')} <> '{sj.BOOLEAN}' OR {out.raw('ok')} <> 'true' "
            f"THEN concat('ok must be true, got ', {got('ok')}) END")
    for name in checked_texts:
        problems.append(
            f"CASE WHEN {out.kind(name)} <> '{sj.STRING}' OR {is_blank(out.raw(name))} "
            f"THEN '{name} must be a non-empty string' END")
    choices = ", ".join(f"'{c}'" for c in CONFIDENCE)
    problems.append(
        f"CASE WHEN {out.kind(confidence)} <> '{sj.STRING}' OR {out.raw(confidence)} NOT IN ({choices}) "
        f"THEN concat('confidence must be one of {'|'.join(CONFIDENCE)}, got ', {got(confidence)}) END")
    for name in lists:
        kind, raw = out.kind(name), out.raw(name)
        length = (f"CASE WHEN {sj.is_array(kind)} THEN size(from_json({raw}, 'array<string>')) "
                  f"WHEN {kind} = '{sj.STRING}' THEN length({raw}) END")
        problems.append(
            f"CASE WHEN NOT {sj.is_array(kind)} OR ({length}) <> {LIST_LENGTH} "
            f"THEN concat('{name} must be an array of length {LIST_LENGTH}, got length ', "
            f"coalesce(CAST({length} AS STRING), 'undefined')) END")
    absent = f"array_compact(array({', '.join(missing)}))"
    return out.attach(replies).selectExpr(
        *replies.columns,
        f"""CASE WHEN NOT {out.is_object()} THEN array('reply is not a JSON object')
            WHEN size({absent}) > 0 THEN {absent}
            ELSE array_compact(array({', '.join(problems)})) END AS errors""",
    )
