"""Split archived agency responses into raw rows (bronze).

Input: a DataFrame of responses ``(source, content binary, received_at,
archive_uri, ...)`` as read by :func:`seismerge.sources.archive.scan_archive`
or produced by the fixture renderer. Output: one row per reported event with
the element's JSON text as ``payload``. All parsing is native (``from_json``,
``get_json_object``, ``regexp_extract``); a response that is not valid JSON
goes to a quarantine frame instead of failing the job (S8).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalar import decode_latin5, py_fixed, to_double_or_null

JSON_SOURCES = ("AFAD", "EMSC", "USGS")

# Python's str.splitlines() line boundaries.
_LINE_BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85  ]"
# What the first eight blank-separated tokens of a KOERI catalogue line look
# like (date, time, three decimals, three scales that may be "-.-").
_DECIMAL, _SCALE = r"(?U)^-?\d+[.]\d+$", r"(?U)^[\d.-]+$"
_KOERI_TOKENS = (r"(?U)^\d{4}([.]\d\d){2}$", r"(?U)^\d\d(:\d\d){2}$", _DECIMAL, _DECIMAL, _DECIMAL,
                 _SCALE, _SCALE, _SCALE)
# Trailing words taken as KOERI's solution-quality tag.
KOERI_QUALITY_WORDS = ("manual", "automatic", "auto", "revised")

_META = ["source", "received_at", "archive_uri"]


def _json_text(content: Column) -> Column:
    """The response's text, null if its bytes are not UTF-8."""
    return F.try_validate_utf8(content.cast("string"))


def _json_kind(text: Column) -> Column:
    """Not null for valid JSON, also with a repeated key (the last one counts)."""
    return F.get_json_object(text, "$")


def _json_elements(source: Column, text: Column) -> Column:
    """The list of element texts for one JSON response.

    AFAD: a top-level list, or ``{"result": [...]}``; EMSC/USGS: ``.features``.
    An empty EMSC/USGS response counts as ``{}`` (no rows).
    """
    afad = F.coalesce(F.from_json(text, "array<string>"),
                      F.from_json(text, "struct<result:array<string>>")["result"],
                      F.array().cast("array<string>"))
    feats = F.coalesce(F.from_json(text, "struct<features:array<string>>")["features"],
                       F.array().cast("array<string>"))
    return F.when(source == "AFAD", afad).otherwise(feats)


def _json_event_id(source: Column, item: Column) -> Column:
    """str(eventID), rows without one dropped. S3: id, or properties.unid
    when id is empty. S4: id, rows with an empty id dropped."""
    # Null if empty, and read once.
    fid = F.get(F.filter(F.array(F.get_json_object(item, "$.id")), lambda i: i != ""), 0)
    return (F.when(source == "AFAD", F.get_json_object(item, "$.eventID"))
            .when(source == "EMSC", F.coalesce(fid, F.get_json_object(item, "$.properties.unid")))
            .when(source == "USGS", fid))


def json_split_evaluate(responses: DataFrame, split_path: str, id_path: str,
                        text_col: str = "text") -> DataFrame:
    """Split each JSON document at ``split_path`` (a JSONPath naming an
    array, e.g. ``$.features``; ``$`` for a top-level array) and extract an
    attribute by JSONPath from each element: one row per element with the
    element text as ``payload`` and the attribute (null if absent) as ``id``.
    """
    arr = F.from_json(F.get_json_object(F.col(text_col), split_path), "array<string>")
    keep = [c for c in responses.columns if c != text_col]
    return (responses.select(*keep, F.posexplode(F.coalesce(arr, F.array().cast("array<string>")))
                             .alias("ordinal", "payload"))
            .withColumn("id", F.get_json_object("payload", id_path)))


def parse_json_responses(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(raw rows, quarantined responses) for the JSON agencies."""
    r = responses.where(F.col("source").isin(*JSON_SOURCES, "")) \
        .select(*_META, _json_text(F.col("content")).alias("text"))
    empty_ok = (F.col("source") != "AFAD") & (F.trim(F.col("text")) == "")
    shape = F.regexp_extract("text", r"(?s)^\s*(.)", 1)
    reason = (F.when(F.col("source") == "", "unknown layout").when(F.col("text").isNull(), "invalid utf-8")
              .when(empty_ok, None).when(_json_kind(F.col("text")).isNull(), "invalid json")
              .when(~shape.isin("{", "["), "not a list or object"))
    r = r.withColumn("reason", reason)
    quarantine = r.where("reason is not null").select(*_META, "reason")
    rows = (r.where("reason is null")
            .select(*_META, F.posexplode(_json_elements(F.col("source"), F.col("text")))
                    .alias("ordinal", "payload"))
            # A generator's output, so that the check does not read it again.
            .select("*", F.explode(F.array(_json_event_id(F.col("source"), F.col("payload")))).alias("event_id"))
            .where(F.col("event_id").isNotNull()))
    return rows.select("source", "event_id", "payload", "received_at", "archive_uri", "ordinal"), \
        quarantine


def _koeri_tokens(line: Column) -> Column:
    """A line's first eight tokens and what follows them."""
    return F.split(F.regexp_replace(line, r"(?U)^\s+", ""), r"(?U)\s+", 9)


def _is_koeri_line(line: Column, tok: Column) -> Column:
    ok = (F.get(tok, 8) != "") | line.rlike(r"(?U)\s\s$")  # something follows, if only blanks
    for k, like in enumerate(_KOERI_TOKENS):
        ok = ok & F.get(tok, k).rlike(like)
    return F.coalesce(ok, F.lit(False)) & ~line.contains("Tarih") & ~line.contains("Date")


def koeri_records(text: Column) -> Column:
    """S5 line parsing: the tokens of the catalogue lines of the page's first
    ``pre`` block. Rules and headers fail the token checks. What later steps
    use more than once is a field of its own, so that each line is taken apart
    once."""
    opened = F.get(F.split(text, r"(?i)<pre[^>]*>", 2), 1)
    block = F.when(opened.rlike(r"(?i)</pre>"), F.get(F.split(opened, r"(?i)</pre>", 2), 0))
    lines = F.transform(F.split(block, _LINE_BREAKS), lambda ln: F.struct(ln.alias("line"), _koeri_tokens(ln).alias("tok")))
    kept = F.filter(lines, lambda r: _is_koeri_line(r["line"], r["tok"]))
    kept = F.transform(kept, lambda r: F.struct(
        r["tok"].alias("tok"), F.regexp_replace(F.element_at(r["tok"], 9), r"(?U)\s+$", "").alias("rest")))
    return F.transform(kept, lambda r: F.struct(
        r["tok"].alias("tok"), r["rest"].alias("rest"), F.regexp_extract(r["rest"], r"(?U)^(.*\S)\s+(\S+)$", 2).alias("tail")))


def _koeri_fields(record: Column) -> list[Column]:
    """Fields of an accepted line; the last token holds the place and a
    quality tag, if there is one."""
    rest, tail = record["rest"], record["tail"]
    g = lambda i: F.element_at(record["tok"], i)
    head = F.regexp_extract(rest, r"(?U)^(.*\S)\s+(\S+)$", 1)
    is_tag = (tail != "") & F.lower(tail).isin(*KOERI_QUALITY_WORDS)
    mag = lambda t: F.when(t == "-.-", None).otherwise(to_double_or_null(t))
    date = F.replace(g(1), F.lit("."), F.lit("-"))
    return [
        date.alias("date"), g(2).alias("time"), g(3).cast("double").alias("latitude"),
        g(4).cast("double").alias("longitude"), g(5).cast("double").alias("depth_km"),
        mag(g(6)).alias("md"), mag(g(7)).alias("ml"), mag(g(8)).alias("mw"),
        F.when(is_tag, F.regexp_replace(head, r"(?U)^\s+|\s+$", "")).otherwise(rest).alias("place"),
        F.when(is_tag, tail).alias("quality"),
    ]


def parse_koeri_responses(responses: DataFrame) -> DataFrame:
    """S5 + S6: KOERI HTML pages (ISO-8859-9) -> raw rows with a synthetic id
    ``KOERI-<date>T<time>-<lat:.3f>-<lon:.3f>``."""
    r = responses.where(F.col("source") == "KOERI") \
        .select(*_META, decode_latin5(F.col("content")).alias("text"))
    # The generator emits whole records: its output is a plain column, so the
    # optimizer cannot inline the per-field regex work into every later use.
    recs = F.transform(koeri_records(F.col("text")), lambda rec: F.struct(*_koeri_fields(rec)))
    rec = r.select(*_META, F.posexplode(recs).alias("ordinal", "rec"))
    eid = F.format_string("KOERI-%sT%s-%s-%s", F.col("rec.date"), F.col("rec.time"),
                          py_fixed(F.col("rec.latitude"), 3), py_fixed(F.col("rec.longitude"), 3))
    return rec.select("source", eid.alias("event_id"),
                      F.to_json("rec", {"ignoreNullFields": "false"}).alias("payload"),
                      "received_at", "archive_uri", "ordinal")


def parse_responses(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All agencies: (raw rows, quarantine). ``ordinal`` is the element's
    position in its response, so (received_at, archive_uri, ordinal) is the
    arrival order used by the upsert policies."""
    rows, quarantine = parse_json_responses(responses)
    return rows.unionByName(parse_koeri_responses(responses)), quarantine
