"""The registered queries in SQL, written independently of the Spark code."""

from __future__ import annotations

# Fixed values of the contract, written out here so that the SQL does not lean on the code it checks.
WHITESPACE = '\\t\\n\\x0B\\f\\r \\x{00A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{FEFF}'
PROMPT_HEAD = """You assist on-call engineers of an incident platform.
Summarise the production incident below. State only what the input supports, and name weak or conflicting evidence.

Rules for the reply, which is one JSON object and nothing else:
- summary: 2 to 4 sentences, fewer than 90 words, no markdown.
- customer_impact: 1 or 2 sentences.
- likely_root_cause: "Unknown based on current evidence" when unclear.
- confidence: LOW, MEDIUM or HIGH, by strength of evidence.
- next_actions: exactly 3 specific imperative items.
- signals: exactly 3 concrete observations from the context.

Context
"""
PROMPT_TASK = '\n\nTask: write the JSON summary of this incident.'

ISO = "%Y-%m-%dT%H:%M:%S.%gZ"
FIXED = "2026-01-01T00:00:00.000Z"

LOG = f"""
b AS (
  SELECT event_id AS o,
         CASE WHEN event_id % 10 = 9 THEN event_id - 1 ELSE event_id END AS sid,
         user_id AS u, event_type AS et, value,
         CAST(json_extract_string(props, '$.k') AS INT) AS k,
         ts - to_hours(CAST(6 * (event_id % 4) AS INT)) AS ets
  FROM events),
f AS (
  SELECT *, 'evt-' || sid AS id, 'inc-' || u AS inc, 'org-' || (u % 5) AS org, 'svc-' || (k % 7) AS svc,
         CASE WHEN value >= 150 THEN 'CRITICAL' WHEN value >= 60 THEN 'HIGH'
              WHEN value >= 20 THEN 'MEDIUM' ELSE 'LOW' END AS sev,
         CASE et WHEN 'purchase' THEN 'ARTIFACT_ATTACHED' WHEN 'view' THEN 'INCIDENT_NOTE'
                 ELSE 'INCIDENT_REPORTED' END AS typ,
         CASE WHEN o % 97 = 5 THEN 'FORCE_DLQ ' ELSE '' END || et || ' k=' || k AS msg,
         strftime(ets, '{ISO}') AS iso
  FROM b),
log AS (
  SELECT 'incident-events' AS topic, 0 AS "partition", o AS "offset", inc AS key,
    CASE WHEN o % 211 = 7 THEN NULL
         WHEN o % 101 = 3 THEN '{{"id":"' || id || '","incidentId":'
         WHEN o % 307 = 11 THEN 'null'
         ELSE '{{"id":"' || id || '","incidentId":"' || inc || '"'
           || CASE WHEN o % 53 = 4 THEN '' ELSE ',"orgId":"' || org || '"' END
           || ',"serviceName":"' || svc || '"'
           || CASE WHEN o % 4 = 1 THEN '' WHEN o % 11 = 6 THEN ',"severity":null'
                   ELSE ',"severity":"' || sev || '"' END
           || ',"type":"' || typ || '"'
           || CASE WHEN o % 89 = 8 THEN '' ELSE ',"message":"' || msg || '"' END
           || ',"timestamp":"' || CASE WHEN o % 113 = 10 THEN 'not-a-time' ELSE iso END || '"'
           || CASE WHEN typ = 'ARTIFACT_ATTACHED' AND o % 41 <> 2
                   THEN ',"artifact":{{"bucket":"incident-artifacts","objectKey":"' || inc || '/' || o || '-file-' || k
                     || '.log","originalName":"file ' || k || '.log","mimeType":"text/plain","size":'
                     || CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) || '}}'
                   ELSE '' END || '}}' END AS value
  FROM f)"""


def _routed(log: str = "log", name: str = "routed") -> str:
    return f"""
{name}_json AS (
  SELECT *, CASE WHEN json_valid(value) THEN CAST(value AS JSON) END AS d FROM {log}),
{name}_fields AS (
  SELECT *,
    d IS NOT NULL AND json_type(d) <> 'NULL' AS decodable,
    json_type(d, '$.message') AS message_kind,
    json_type(d, '$.severity') AS severity_kind,
    CASE WHEN json_type(d, '$.id') = 'VARCHAR' THEN json_extract_string(d, '$.id') END AS event_id,
    CASE WHEN json_type(d, '$.incidentId') = 'VARCHAR' THEN json_extract_string(d, '$.incidentId') END AS incident_id,
    CASE WHEN json_type(d, '$.orgId') = 'VARCHAR' THEN json_extract_string(d, '$.orgId') END AS org_id,
    CASE WHEN json_type(d, '$.serviceName') = 'VARCHAR' THEN json_extract_string(d, '$.serviceName') END AS service_name,
    CASE WHEN json_type(d, '$.severity') = 'VARCHAR' THEN json_extract_string(d, '$.severity') END AS severity,
    CASE WHEN json_type(d, '$.message') = 'VARCHAR' THEN json_extract_string(d, '$.message') END AS message,
    json_extract_string(d, '$.type') AS event_type,
    TRY_CAST(json_extract_string(d, '$.timestamp') AS TIMESTAMP) AS event_ts,
    json_type(d, '$.artifact') AS artifact_kind,
    json_extract_string(d, '$.artifact.bucket') AS bucket,
    json_extract_string(d, '$.artifact.objectKey') AS object_key,
    json_extract_string(d, '$.artifact.originalName') AS original_name,
    json_extract_string(d, '$.artifact.mimeType') AS mime_type,
    CAST(json_extract_string(d, '$.artifact.size') AS BIGINT) AS size
  FROM {name}_json),
{name}_judged AS (
  SELECT *, CASE
    WHEN NOT decodable THEN 'dlq_raw'
    WHEN message_kind IS NULL OR message_kind NOT IN ('VARCHAR', 'ARRAY') THEN 'dlq_message'
    WHEN contains(message, 'FORCE_DLQ') THEN 'dlq_message'
    WHEN event_id IS NULL THEN 'dlq_message'
    WHEN event_type = 'INCIDENT_REPORTED' THEN CASE
      WHEN coalesce(incident_id, '') = '' OR event_ts IS NULL OR message IS NULL THEN 'lost_after_mark'
      WHEN coalesce(org_id, '') = '' OR service_name IS NULL
        OR coalesce(severity_kind, 'NULL') NOT IN ('NULL', 'VARCHAR') THEN 'projected_timeline_only'
      ELSE 'projected_full' END
    WHEN event_type = 'ARTIFACT_ATTACHED' THEN CASE
      WHEN coalesce(incident_id, '') = '' OR event_ts IS NULL OR coalesce(artifact_kind, 'NULL') = 'NULL'
        THEN 'lost_after_mark'
      ELSE 'projected_artifact' END
    ELSE 'ignored_type' END AS verdict
  FROM {name}_fields),
{name}_ranked AS (
  SELECT *, verdict NOT IN ('dlq_raw', 'dlq_message') AS marks,
    row_number() OVER (
      PARTITION BY event_id, verdict NOT IN ('dlq_raw', 'dlq_message') ORDER BY "partition", "offset") AS rn
  FROM {name}_judged),
{name} AS (
  SELECT *, CASE WHEN marks AND rn > 1 THEN 'duplicate' ELSE verdict END AS route FROM {name}_ranked)"""


TABLES = f"""
timeline AS (
  SELECT incident_id, event_ts, event_id, event_type, message FROM routed
  WHERE route IN ('projected_full', 'projected_timeline_only')),
artifacts AS (
  SELECT incident_id, event_ts AS uploaded_at, event_id AS artifact_id, bucket, object_key, original_name,
    mime_type, size AS size_bytes
  FROM routed WHERE route = 'projected_artifact'),
health AS (
  SELECT org_id, service_name,
    arg_max(incident_id, "offset") AS latest_incident_id,
    arg_max(event_id, "offset") AS latest_event_id,
    arg_max_null(severity, "offset") FILTER (WHERE severity_kind IS NOT NULL) AS severity,
    CASE WHEN coalesce(arg_max_null(severity, "offset"), '') = 'CRITICAL' THEN 'DEGRADED' ELSE 'ACTIVE' END AS status,
    arg_max_null(severity, "offset") AS last_severity,
    arg_max(event_ts, "offset") AS last_updated,
    arg_max(message, "offset") AS message,
    max("offset") AS last_offset
  FROM routed WHERE route = 'projected_full' GROUP BY org_id, service_name)"""

BASE = f"WITH {LOG}, {_routed()}, {TABLES}"

_DEAD = """
dead AS (
  SELECT CASE WHEN route = 'dlq_raw' THEN 'unknown' ELSE incident_id END AS "incidentId",
    '{fixed}' AS "failedAt",
    CASE WHEN route = 'dlq_raw' THEN 0 ELSE 3 END AS "retryCount",
    CASE WHEN value IS NULL THEN 'Cannot read properties of null (reading ''toString'')'
         WHEN value = 'null' THEN 'Cannot read properties of null (reading ''id'')'
         WHEN route = 'dlq_raw' THEN 'value is not valid JSON'
         WHEN contains(message, 'FORCE_DLQ') THEN 'Forced failure for DLQ test'
         ELSE 'Cannot read properties of undefined (reading ''includes'')' END AS "errorMessage",
    topic AS "originalTopic", "partition" AS "originalPartition", CAST("offset" AS VARCHAR) AS "originalOffset",
    CASE WHEN route = 'dlq_message' THEN value END AS "originalMessage",
    CASE WHEN route = 'dlq_raw' THEN value END AS "originalRawValue"
  FROM routed WHERE route IN ('dlq_raw', 'dlq_message'))""".format(fixed=FIXED)

_REQUESTS = """
requests AS (
  SELECT 'req-' || u AS request_id,
    CASE WHEN u % 31 = 4 THEN '' WHEN u % 29 = 3 THEN 'inc-none-' || u ELSE 'inc-' || u END AS incident_id,
    CASE WHEN u % 3 = 0 THEN NULL WHEN u % 7 = 1 THEN 'org-none' ELSE 'org-' || (u % 5) END AS org_id,
    CASE u % 8 WHEN 0 THEN 20 WHEN 1 THEN 3 WHEN 2 THEN 0 WHEN 3 THEN -1 WHEN 4 THEN 0
      WHEN 5 THEN 2 WHEN 6 THEN 20 ELSE 1500 END AS take
  FROM (SELECT DISTINCT user_id AS u FROM events)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY incident_id ORDER BY event_ts DESC, event_id) AS position,
    count(*) OVER (PARTITION BY incident_id) AS total
  FROM timeline),
recent AS (
  SELECT r.request_id, t.position, t.event_id, t.event_type, t.message, strftime(t.event_ts, '{iso}') AS event_timestamp
  FROM requests r JOIN ranked t ON r.incident_id = t.incident_id
  WHERE t.position <= CASE WHEN r.take < 0 THEN t.total + r.take ELSE r.take END),
context AS (
  SELECT r.request_id, r.incident_id, r.org_id, e.events, coalesce(h.services, 0) AS services,
    e.events_text, coalesce(h.health_text, '(not provided)') AS health_text, coalesce(h.degraded, 0) AS degraded
  FROM requests r
  JOIN (SELECT request_id, count(*) AS events,
          string_agg(position || '. ' || event_timestamp || ' - ' || event_type || ' - ' || message, chr(10)
                     ORDER BY position) AS events_text
        FROM recent GROUP BY request_id) e ON e.request_id = r.request_id
  LEFT JOIN (SELECT org_id, count(*) AS services, count(*) FILTER (WHERE status = 'DEGRADED') AS degraded,
          string_agg('- ' || service_name || ': ' || status || ' (severity=' || coalesce(severity, 'null') || ') — '
                     || message || ' @ ' || strftime(last_updated, '{iso}'), chr(10) ORDER BY service_name) AS health_text
        FROM health GROUP BY org_id) h ON h.org_id = r.org_id)""".format(iso=ISO)


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_PROMPT = (
    f"{_literal(PROMPT_HEAD)} || 'Incident ID: ' || incident_id || chr(10) || 'Org ID: ' || coalesce(org_id, 'unknown')"
    " || chr(10) || chr(10) || 'Recent events, newest first:' || chr(10) || events_text"
    " || chr(10) || chr(10) || 'Service health of the organisation:' || chr(10) || health_text"
    f" || {_literal(PROMPT_TASK)}"
)


def _replies(shape: str) -> str:
    camel = shape == "graphql"
    names = (
        ("customerImpact", "likelyRootCause", "nextActions") if camel
        else ("customer_impact", "likely_root_cause", "next_actions")
    )
    outer = ""
    if shape == "rest":
        outer = """'"ok":' || CASE WHEN event_id % 13 = 5 THEN 'false' ELSE 'true' END || ',' || """
    if shape in ("rest", "graphql"):
        outer += """CASE WHEN event_id % 17 = 3 THEN '' ELSE '"incidentId":"inc-' || user_id || '",' END || """
    return f"""
texts AS (
  SELECT 'reply-' || event_id AS request_id, 'inc-' || user_id AS incident_id, event_id AS o,
    '{{' || {outer}
    CASE event_id % 12 WHEN 1 THEN '' WHEN 2 THEN '"summary":"  ",' WHEN 9 THEN '"summary":5,'
      ELSE '"summary":"' || event_type || ' number ' || json_extract_string(props, '$.k') || '",' END
    || CASE event_id % 12 WHEN 3 THEN '"{names[0]}":"",' ELSE '"{names[0]}":"some users",' END
    || '"{names[1]}":"unknown",'
    || CASE WHEN event_id % 12 = 4 THEN '"confidence":"SURE",' WHEN event_id % 12 = 10 THEN '"confidence":null,'
       WHEN value >= 60 THEN '"confidence":"HIGH",' ELSE '"confidence":"LOW",' END
    || CASE event_id % 12 WHEN 5 THEN '"{names[2]}":["a","b"],' WHEN 7 THEN '"{names[2]}":"abc",'
       ELSE '"{names[2]}":["a","b","c"],' END
    || CASE event_id % 12 WHEN 6 THEN '"signals":["s","t","u","v"]' WHEN 11 THEN '"signals":null'
       ELSE '"signals":["s' || json_extract_string(props, '$.k') || '","t","u"]' END
    || '}}' || CASE WHEN event_id % 12 = 8 THEN ' and more' ELSE '' END AS reply
  FROM events),
replies AS (
  SELECT *, json_valid(reply) AS decoded, CASE WHEN json_valid(reply) THEN CAST(reply AS JSON) END AS d FROM texts)"""


def _string(name: str) -> str:
    return f"CASE WHEN json_type(d, '$.{name}') = 'VARCHAR' THEN json_extract_string(d, '$.{name}') END"


def _list(name: str) -> str:
    return (
        f"CASE WHEN json_type(d, '$.{name}') = 'ARRAY' "
        f"THEN array_to_string(json_extract_string(d, '$.{name}[*]'), '|') END"
    )


_DECODED = ", ".join(
    [f"{_string(n)} AS {n}" for n in ("summary", "customer_impact", "likely_root_cause", "confidence")]
    + [f"{_list(n)} AS {n}" for n in ("next_actions", "signals")]
)


def _validation(shape: str) -> str:
    camel = shape == "graphql"
    texts = ["summary", "customerImpact", "likelyRootCause"] if camel else [
        "summary", "customer_impact", "likely_root_cause"]
    lists = ["nextActions", "signals"] if camel else ["next_actions", "signals"]
    outer = {"summary": [], "rest": ["ok", "incidentId"], "graphql": ["incidentId"]}[shape]
    fields = [*outer, *texts, "confidence", *lists]
    missing = ", ".join(f"CASE WHEN json_type(d, '$.{n}') IS NULL THEN 'missing field: {n}' END" for n in fields)
    checks = []
    if shape == "rest":
        checks.append("CASE WHEN json_type(d, '$.ok') <> 'BOOLEAN' OR CAST(json_extract(d, '$.ok') AS VARCHAR) <> 'true' "
                      "THEN 'ok must be true, got ' || CAST(json_extract(d, '$.ok') AS VARCHAR) END")
    for n in texts if shape == "summary" else texts[:1]:
        checks.append(f"CASE WHEN json_type(d, '$.{n}') <> 'VARCHAR' OR trim(json_extract_string(d, '$.{n}')) = '' "
                      f"THEN '{n} must be a non-empty string' END")
    checks.append("CASE WHEN coalesce(json_extract_string(d, '$.confidence'), '') NOT IN ('LOW', 'MEDIUM', 'HIGH') "
                  "THEN 'confidence must be one of LOW|MEDIUM|HIGH, got ' "
                  "|| CAST(json_extract(d, '$.confidence') AS VARCHAR) END")
    for n in lists:
        checks.append(
            f"CASE WHEN json_type(d, '$.{n}') <> 'ARRAY' OR json_array_length(d, '$.{n}') <> 3 "
            f"THEN '{n} must be an array of length 3, got length ' || CASE json_type(d, '$.{n}') "
            f"WHEN 'ARRAY' THEN CAST(json_array_length(d, '$.{n}') AS VARCHAR) "
            f"WHEN 'VARCHAR' THEN CAST(length(json_extract_string(d, '$.{n}')) AS VARCHAR) "
            f"ELSE 'undefined' END END")
    return f"""WITH {_replies(shape)}, checked AS (
  SELECT request_id, decoded,
    concat_ws('; ', {missing}) AS missing,
    concat_ws('; ', {', '.join(checks)}) AS problems
  FROM replies)
SELECT request_id, CASE WHEN NOT decoded THEN 'reply is not a JSON object'
  WHEN missing <> '' THEN missing ELSE problems END AS errors
FROM checked"""


_BODIES = """
bodies AS (
  SELECT event_id AS o, user_id AS u, event_type AS et, strftime(ts, '{iso}') AS iso,
    CAST(json_extract_string(props, '$.k') AS INT) % 7 AS s,
    CASE WHEN event_id % 7 = 3 THEN '""' ELSE '"inc-' || user_id || '"' END AS inc,
    CASE WHEN event_id % 19 = 7 THEN 'false' WHEN event_id % 29 = 9 THEN CAST(user_id AS VARCHAR)
      ELSE '"org-' || (user_id % 5) || '"' END AS org,
    CASE WHEN event_id % 11 = 4 THEN '0' WHEN event_id % 23 = 8 THEN '5' ELSE '"HIGH"' END AS sev,
    event_id % 17 <> 6 AS has_service, event_id % 13 <> 5 AS has_message,
    event_id % 37 <> 10 AS is_body, event_id % 37 <> 10 AND event_id % 41 <> 11 AS is_object
  FROM events)""".format(iso=ISO)

_EVENT_TEXT = """'{{"id":"sub-' || o || '","incidentId":' || inc || ',"orgId":' || {org}
  || ',"serviceName":"svc-' || s || '","severity":' || sev || ',"type":"INCIDENT_REPORTED","message":"' || et
  || '","timestamp":"' || iso || '"}}'"""


def _submitted(accepted: str, org: str) -> str:
    return f"""WITH {_BODIES}, judged AS (SELECT *, is_object AND {accepted} AS ok FROM bodies)
SELECT o AS submission_id, ok,
  CASE WHEN NOT is_body THEN 'body is not a JSON object'
       WHEN NOT ok THEN 'incidentId, orgId, serviceName, severity, and message are required' END AS error,
  CASE WHEN ok THEN replace(inc, '"', '') END AS key,
  CASE WHEN ok THEN {_EVENT_TEXT.format(org=org)} END AS value
FROM judged"""


_SPACES = f"[{WHITESPACE}]+"


def all_oracles() -> dict[str, str]:
    oracles = {
        "event_log_scan": f'WITH {LOG} SELECT topic, "partition", "offset", key, value FROM log',
        "parse_log": f"""{BASE} SELECT "offset", decodable, event_id, incident_id, org_id, service_name, severity,
  CASE severity_kind WHEN 'VARCHAR' THEN 'text' WHEN 'NULL' THEN 'null' END AS severity_kind, event_type, message,
  strftime(event_ts, '{ISO}') AS event_time, object_key, size FROM routed""",
        "route_events": f'{BASE} SELECT "offset", event_id, route FROM routed',
        "route_counts": f"{BASE} SELECT route, count(*) AS n FROM routed GROUP BY route",
        "dedup_first_seen": f"""{BASE} SELECT event_id AS message_id, "offset", verdict FROM routed
WHERE marks AND rn = 1 AND event_id NOT IN (
  SELECT 'evt-' || event_id FROM events WHERE event_type = 'purchase' AND value >= 100)""",
        "message_deliveries": f"""{BASE} SELECT event_id AS message_id, min("offset") AS first_offset,
  count(*) AS deliveries FROM routed WHERE marks GROUP BY event_id""",
        "processed_ledger": f"""{BASE} SELECT DISTINCT 'incident-events-projection-group' AS consumer_group,
  event_id AS message_id, '{FIXED}' AS processed_at FROM routed WHERE marks""",
        "dead_letters": f"{BASE}, {_DEAD} SELECT * FROM dead",
        "dead_letter_messages": f"""{BASE}, {_DEAD} SELECT 'incident-events-dlq' AS topic,
  coalesce(nullif("incidentId", ''), 'unknown') AS key,
  CASE WHEN "retryCount" = 3 THEN '{{"incidentId":"' || "incidentId" || '","failedAt":"' || "failedAt"
    || '","retryCount":3,"errorMessage":"' || "errorMessage" || '","originalTopic":"' || "originalTopic"
    || '","originalPartition":' || "originalPartition" || ',"originalOffset":"' || "originalOffset"
    || '","originalMessage":' || "originalMessage" || '}}'
  ELSE '{{"incidentId":"unknown","failedAt":"' || "failedAt"
    || '","retryCount":0,"errorMessage":"' || "errorMessage" || '","originalTopic":"' || "originalTopic"
    || '","originalPartition":' || "originalPartition" || ',"originalOffset":"' || "originalOffset"
    || '","originalRawValue":' || coalesce(CAST(to_json("originalRawValue") AS VARCHAR), 'null') || '}}' END AS value
FROM dead""",
        "dlq_replay": f"""{BASE} SELECT topic, "offset" AS source_offset, incident_id AS key, value, 'true' AS replayed
FROM routed WHERE route = 'dlq_message'""",
        "replay_reprocess": f"""WITH {LOG}, {_routed("log", "once")},
appended AS (
  SELECT topic, "partition", "offset", key, value, NULL AS replayed FROM log
  UNION ALL
  SELECT topic, "partition", (SELECT max("offset") FROM log) + row_number() OVER (ORDER BY "offset"),
    incident_id, value, 'true'
  FROM once WHERE route = 'dlq_message'),
{_routed("appended", "twice")}
SELECT "offset", replayed, event_id, route FROM twice""",
        "replay_attempts": f"""{BASE} SELECT topic || '/' || "partition" || '/' || rank AS origin,
  CASE route WHEN 'dlq_message' THEN 3 ELSE 0 END AS replays,
  CASE route WHEN 'dlq_message' THEN 'exhausted' ELSE 'not_replayable' END AS status
FROM (SELECT *, row_number() OVER (ORDER BY "offset") - 1 AS rank FROM routed)
WHERE route IN ('dlq_raw', 'dlq_message')""",
        "incident_timeline": f"""{BASE} SELECT event_id AS id, incident_id AS "incidentId", event_type AS type, message,
  strftime(event_ts, '{ISO}') AS timestamp FROM timeline ORDER BY incident_id, event_ts DESC, event_id""",
        "timeline_counts": f"""{BASE} SELECT incident_id AS "incidentId", count(*) AS events
FROM timeline GROUP BY incident_id""",
        "service_health_current": f"""{BASE} SELECT org_id, service_name, latest_incident_id, latest_event_id, severity,
  status, strftime(last_updated, '{ISO}') AS last_updated, message, last_offset FROM health""",
        "service_health_null_severity": f"""{BASE} SELECT org_id, service_name, latest_event_id,
  last_severity AS severity, status FROM health""",
        "service_health_by_org": f"""{BASE} SELECT org_id AS "orgId", service_name AS "serviceName",
  latest_incident_id AS "latestIncidentId", latest_event_id AS "latestEventId", severity, status,
  strftime(last_updated, '{ISO}') AS "lastUpdated", message FROM health ORDER BY org_id, service_name""",
        "incident_artifacts": f"""{BASE} SELECT artifact_id AS "artifactId", incident_id AS "incidentId", bucket,
  object_key AS "objectKey", original_name AS "originalName", mime_type AS "mimeType", size_bytes AS "sizeBytes",
  strftime(uploaded_at, '{ISO}') AS "uploadedAt" FROM artifacts
ORDER BY incident_id, artifacts.uploaded_at DESC, artifact_id""",
        "artifact_locations": f"""{BASE} SELECT artifact_id AS "artifactId", incident_id AS "incidentId",
  's3a://' || bucket || '/' || object_key AS location, '2026-01-01T00:15:00.000Z' AS "expiresAt" FROM artifacts""",
        "stored_artifact_lookup": f"""{BASE}, numbered AS (
  SELECT *, CAST(split_part(artifact_id, '-', 2) AS BIGINT) % 29 AS m FROM artifacts WHERE object_key IS NOT NULL)
SELECT replace(object_key, '/', '%2F') || CASE m WHEN 6 THEN '%E0%A4' WHEN 8 THEN '+%20copy' ELSE '' END AS path,
  CASE m WHEN 6 THEN NULL WHEN 8 THEN object_key || '+ copy' ELSE object_key END AS "objectKey",
  CASE WHEN m NOT IN (6, 8) THEN bucket END AS bucket,
  CASE WHEN m NOT IN (6, 8) THEN artifact_id END AS "artifactId",
  CASE WHEN m NOT IN (6, 8) THEN incident_id END AS "incidentId" FROM numbered""",
        "contract_violations": f"""{BASE}
SELECT 'serviceHealthByOrg' AS view, latest_event_id AS key, 'severity' AS "column", 'null' AS reason
FROM health WHERE severity IS NULL
UNION ALL
SELECT 'incidentArtifacts', artifact_id, c, 'null' FROM (
  SELECT artifact_id, unnest(['bucket', 'objectKey', 'originalName', 'mimeType', 'sizeBytes']) AS c,
    unnest([bucket, object_key, original_name, mime_type, CAST(size_bytes AS VARCHAR)]) AS v FROM artifacts)
WHERE v IS NULL
UNION ALL
SELECT 'incidentArtifacts', artifact_id, 'sizeBytes', 'not a 32-bit integer' FROM artifacts
WHERE size_bytes NOT BETWEEN -2147483648 AND 2147483647
UNION ALL
SELECT 'incidentTimeline', event_id, 'message', 'null' FROM timeline WHERE message IS NULL""",
        "recent_events": f"{BASE}, {_REQUESTS} SELECT * FROM recent",
        "summary_requests": f"""{BASE}, {_REQUESTS} SELECT r.request_id, r.incident_id, count(t.request_id) AS events,
  CASE WHEN r.incident_id = '' THEN 'INVALID' WHEN count(t.request_id) = 0 THEN 'NOT_FOUND' ELSE 'OK' END AS status
FROM requests r LEFT JOIN recent t ON r.request_id = t.request_id GROUP BY r.request_id, r.incident_id""",
        "requests_not_found": f"""{BASE}, {_REQUESTS} SELECT request_id, incident_id FROM requests
WHERE request_id NOT IN (SELECT request_id FROM recent)""",
        "summary_context": f"""{BASE}, {_REQUESTS} SELECT request_id, incident_id, org_id, events, services, events_text,
  health_text FROM context""",
        "summary_prompts": f"{BASE}, {_REQUESTS} SELECT request_id, incident_id, {_PROMPT} AS prompt FROM context",
        "summarize_incidents": f"""{BASE}, {_REQUESTS}, firsts AS (
  SELECT *, split_part(events_text, chr(10), 1) AS latest FROM context)
SELECT request_id, incident_id, true AS decoded,
  'Incident ' || incident_id || ': latest event ' || latest AS summary,
  'Unknown' AS customer_impact, 'Unknown based on current evidence' AS likely_root_cause, 'LOW' AS confidence,
  'Review the timeline|Check service health|Update the incident' AS next_actions,
  'event lines: ' || events || '|degraded services: ' || degraded || '|' || latest AS signals
FROM firsts""",
        "summarize_with_failures": f"""{BASE}, {_REQUESTS}, judged AS (
  SELECT *, CAST(split_part(incident_id, '-', 2) AS INT) % 7 = 0 AS refused FROM context)
SELECT request_id, incident_id, NOT refused AS decoded,
  CASE WHEN refused THEN 'ValueError: no reply for ' || incident_id END AS error,
  CASE WHEN NOT refused THEN 'LOW' END AS confidence FROM judged""",
        "incident_timeline_by_key": f"""{BASE} SELECT event_id AS id, event_type AS type,
  strftime(event_ts, '{ISO}') AS timestamp FROM timeline WHERE incident_id = (SELECT min(incident_id) FROM timeline)""",
        "stored_dead_letter_replay": f"""{BASE} SELECT topic, topic AS source_topic, "offset" AS source_offset,
  incident_id AS key, value FROM routed WHERE route = 'dlq_message'""",
        "submit_publish_project": f"""WITH {_BODIES}
SELECT 'sub-' || o AS id, replace(inc, '"', '') AS "incidentId", 'INCIDENT_REPORTED' AS type, et AS message, iso AS timestamp
FROM bodies WHERE is_object AND inc <> '""' AND org NOT IN ('false', '0') AND has_service AND sev <> '0' AND has_message""",
        "stored_content": """SELECT 'inc-' || (doc_id % 97) || '/1767225600000-document-' || doc_id || '.txt' AS object_key,
  'text/plain' AS mime_type, CAST(octet_length(encode(text)) AS BIGINT) AS size, md5(reverse(text)) AS md5
FROM documents WHERE octet_length(encode(text)) <= 10485760""",
        "parse_summaries": f"WITH {_replies('summary')} SELECT request_id, incident_id, decoded, {_DECODED} FROM replies",
        "summary_graphql_view": f"""WITH {_replies('summary')}, parsed AS (
  SELECT incident_id, {_DECODED} FROM replies WHERE decoded)
SELECT incident_id AS "incidentId", summary, customer_impact AS "customerImpact",
  likely_root_cause AS "likelyRootCause", confidence, next_actions AS "nextActions", signals FROM parsed""",
        "summary_rest_view": f"""WITH {_replies('summary')}
SELECT true AS ok, incident_id AS "incidentId", {_DECODED} FROM replies WHERE decoded""",
        "validate_summaries": _validation("summary"),
        "validate_rest_summaries": _validation("rest"),
        "validate_graphql_summaries": _validation("graphql"),
        "submit_incidents": _submitted(
            "inc <> '\"\"' AND org NOT IN ('false', '0') AND has_service AND sev <> '0' AND has_message", "org"),
        "submit_incidents_graphql": _submitted(
            "org <> 'false' AND has_service AND sev = '\"HIGH\"' AND has_message",
            "CASE WHEN org LIKE '\"%' THEN org ELSE '\"' || org || '\"' END"),
        "register_artifacts": f"""WITH intake AS (
  SELECT event_id AS o, ts,
    CASE WHEN event_id % 19 = 4 THEN NULL WHEN event_id % 17 = 3 THEN '' ELSE 'inc-' || user_id END AS inc,
    CASE WHEN event_id % 23 <> 5 THEN event_type || ' ' || chr(9) || json_extract_string(props, '$.k')
      || chr(65279) || '  dump.log' END AS name,
    CASE WHEN event_id % 5 IN (1, 2) THEN 'application/octet-stream' ELSE 'text/plain' END AS mime,
    CAST(round(value * 100000) AS BIGINT) AS size
  FROM events),
judged AS (
  SELECT *, CASE WHEN size > 10485760 THEN 'File too large' WHEN coalesce(inc, '') = '' THEN 'incidentId is required'
    WHEN name IS NULL THEN 'file is required' END AS error,
    inc || '/' || (epoch_us(ts) // 1000) || '-' || regexp_replace(name, '{_SPACES}', '-', 'g') AS object_key
  FROM intake)
SELECT o AS upload_id, error IS NULL AS ok, error,
  CASE WHEN error IS NULL THEN object_key END AS object_key,
  CASE WHEN error IS NULL THEN inc END AS key,
  CASE WHEN error IS NULL THEN '{{"id":"up-' || o || '","incidentId":"' || inc
    || '","type":"ARTIFACT_ATTACHED","message":' || CAST(to_json('Artifact attached: ' || name) AS VARCHAR)
    || ',"timestamp":"' || strftime(ts, '{ISO}') || '","artifact":{{"bucket":"incident-artifacts","objectKey":'
    || CAST(to_json(object_key) AS VARCHAR) || ',"originalName":' || CAST(to_json(name) AS VARCHAR)
    || ',"mimeType":"' || mime || '","size":' || size || '}}}}' END AS value
FROM judged""",
        "store_artifacts": """SELECT 'inc-' || (doc_id % 97) || '/1767225600000-document-' || doc_id || '.txt' AS object_key,
  'text/plain' AS mime_type, CAST(octet_length(encode(text)) AS BIGINT) AS size, md5(text) AS md5
FROM documents WHERE octet_length(encode(text)) <= 10485760""",
        "stream_project": f"""{BASE}, {_DEAD}
SELECT 'timeline' AS "table", incident_id || '|' || event_id AS key,
  concat_ws('|', strftime(event_ts, '{ISO}'), event_type, message) AS detail FROM timeline
UNION ALL
SELECT 'health', org_id || '|' || service_name,
  concat_ws('|', latest_event_id, severity, status, strftime(last_updated, '{ISO}'), message) FROM health
UNION ALL
SELECT 'artifacts', incident_id || '|' || artifact_id,
  concat_ws('|', strftime(uploaded_at, '{ISO}'), object_key, CAST(size_bytes AS VARCHAR)) FROM artifacts
UNION ALL
SELECT 'dead_letters', "originalOffset", concat_ws('|', CAST("retryCount" AS VARCHAR), "errorMessage") FROM dead
UNION ALL
SELECT DISTINCT 'ledger', event_id, '{FIXED}' FROM routed WHERE marks
UNION ALL
SELECT 'outcomes', route, CAST(count(*) AS VARCHAR) FROM routed GROUP BY route""",
    }
    return oracles | {
        "artifact_file_intake": f"""WITH files AS (
  SELECT 'documents ' || (doc_id // 100) || '.txt' AS original_name, doc_id // 100 AS number,
    string_agg(coalesce(text, '') || chr(10), '' ORDER BY doc_id) AS content
  FROM documents GROUP BY doc_id // 100),
judged AS (SELECT *, CAST(octet_length(encode(content)) AS BIGINT) AS size FROM files)
SELECT original_name, size, size <= 10485760 AS ok, CASE WHEN size > 10485760 THEN 'File too large' END AS error,
  CASE WHEN size <= 10485760 THEN 'inc-files/1767225600000-documents-' || number || '.txt' END AS object_key,
  CASE WHEN size <= 10485760 THEN md5(content) END AS md5 FROM judged""",
        "generated_identities": f"""WITH submitted AS ({oracles["submit_incidents"]}),
attached AS ({oracles["register_artifacts"]}),
made AS (SELECT 'submission' AS kind FROM submitted WHERE ok UNION ALL SELECT 'artifact' FROM attached WHERE ok)
SELECT kind, count(*) AS events, count(*) AS ids, count(*) AS well_formed, CAST(1 AS BIGINT) AS times FROM made GROUP BY kind""",
        "stream_project_keyed": oracles["stream_project"],
        "recent_events_stored": oracles["recent_events"],
        "summarize_incidents_stored": oracles["summarize_incidents"],
        "stored_health_by_org": f"""WITH every AS ({oracles["service_health_by_org"]})
SELECT * FROM every WHERE "orgId" = (SELECT min("orgId") FROM every)""",
    }
