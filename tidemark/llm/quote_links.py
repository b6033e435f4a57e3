"""Conversations in reply order, without quotes.

Lines are parsed by their level of ``>`` marks. Runs of one level, their paragraphs and
lines are normalised and hashed; a quoted run is joined to the first earlier message that
says the same in its own words. The closest level's link makes a message a reply, and
pointer jumping along replies finds each thread. All of it is column expressions, joins and
aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.tables import staged

# White space and the marks of a quoted line, the end of the line that
# introduces a quote.
_SPACE = r"[ \t\r\n\f\x0B]"
_MARKS = r"^[ \t]*>[ \t>]*"
_INTRODUCES = r"(?i)(wrote|writes|said|a écrit|schrieb|escribió)[ \t]*:[ \t\r]*$"
_BLANK = r"\n[ \t\r\f\x0B]*\n[ \t\r\n\f\x0B]*"
_ENDS = " \t\r\n\f\v"


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), f"{_SPACE}+", " "))


def parsed_lines(text: Column) -> Column:
    """Array of (level, body); a line that introduces a quote has the level -1."""
    lines = F.split(F.coalesce(text.cast("string"), F.lit("")), "\n")

    def parsed(line: Column) -> Column:
        marks = F.regexp_extract(line, _MARKS, 0)
        return F.struct(
            F.length(F.regexp_replace(marks, "[^>]", "")).alias("level"),
            F.substring(line, F.length(marks) + 1, F.length(line)).alias("body"),
        )

    both = F.transform(lines, parsed)

    def introduced(pair: Column, at: Column) -> Column:
        after = F.get(both, at + 1)["level"]
        opens = (pair["level"] == 0) & (F.coalesce(after, F.lit(0)) > 0) & pair["body"].rlike(_INTRODUCES)
        return F.struct(F.when(opens, F.lit(-1)).otherwise(pair["level"]).alias("level"), pair["body"].alias("body"))

    return F.transform(both, introduced)


def _runs(lines: Column) -> Column:
    """Array of (level, text): neighbouring lines of one level."""
    places = F.sequence(F.lit(0), F.size(lines) - 1)
    heads = F.filter(places, lambda i: (i == 0) | (F.get(lines, i)["level"] != F.get(lines, i - 1)["level"]))

    def run(head: Column, n: Column) -> Column:
        end = F.coalesce(F.get(heads, n + 1), F.size(lines))
        body = F.transform(F.slice(lines, head + 1, end - head), lambda line: line["body"])
        return F.struct(F.get(lines, head)["level"].alias("level"), F.array_join(body, "\n").alias("text"))

    return F.transform(heads, run)


def _units(text: Column) -> Column:
    """The whole, its paragraphs and its lines as (kind, text)."""

    def of(kind: int, parts: Column) -> Column:
        return F.transform(parts, lambda p: F.struct(F.lit(kind).alias("kind"), p.alias("text")))

    return F.concat(of(0, F.array(text)), of(1, F.split(text, _BLANK)), of(2, F.split(text, "\n")))


def _hashed(units: DataFrame, *keep: str) -> DataFrame:
    """``keep``, then the kind, size and two hashes of what is not blank."""
    normal = _normal(F.col("unit.text"))
    return (
        units.select(*keep, F.col("unit.kind").alias("kind"), normal.alias("_normal"))
        .where("_normal <> ''")
        .select(
            *keep,
            "kind",
            F.length("_normal").alias("size"),
            F.xxhash64(F.lit(1), "_normal").alias("h1"),
            F.xxhash64(F.lit(2), "_normal").alias("h2"),
        )
    )


def own_text(lines: Column) -> Column:
    """What stands outside quotes, without white space around it."""
    own = F.transform(F.filter(lines, lambda p: p["level"] == 0), lambda p: p["body"])
    return F.btrim(F.array_join(own, "\n"), F.lit(_ENDS))


def quote_links(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text") -> DataFrame:
    """``conv``, ``turn``, ``run``, ``level``, ``original``: each quoted run and the turn it is from.

    A whole run counts before its paragraphs and those before its lines; then the message
    with most of it, then the earliest. An original is always an earlier turn.
    """
    lines = messages.select(messages[conv].alias("conv"), messages[turn].alias("turn"), parsed_lines(messages[text]).alias("lines"))
    runs = lines.select("conv", "turn", F.posexplode(_runs(F.col("lines"))).alias("run", "part"))
    units = runs.select("conv", "turn", "run", F.col("part.level").alias("level"), F.explode(_units(F.col("part.text"))).alias("unit"))
    whole = lines.select("conv", "turn", F.struct(F.lit(0).alias("kind"), own_text(F.col("lines")).alias("text")).alias("unit"))
    own = units.where("level = 0").select("conv", "turn", "unit").union(whole)
    # the first to say something: as many rows as there are different things said
    first = _hashed(own, "conv", "turn").groupBy("conv", "h1", "h2").agg(F.min("turn").alias("original"))
    quoted = _hashed(units.where("level > 0"), "conv", "turn", "run", "level")
    found = quoted.join(first, ["conv", "h1", "h2"]).where("original < turn")
    weighed = found.groupBy("conv", "turn", "run", "level", "original", "kind").agg(F.sum("size").alias("size"))
    best = F.max_by("original", F.struct(-F.col("kind"), "size", -F.col("original"))).alias("original")
    return weighed.groupBy("conv", "turn", "run", "level").agg(best).withColumnsRenamed({"conv": conv, "turn": turn})


def reply_order(
    messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The messages sorted by ``conv``, ``thread`` and ``turn``, without quotes.

    ``reply_to`` is the turn a message answers (of its links the lowest level's latest, null
    without one), ``thread`` the turn its thread starts with, ``depth`` the replies since,
    ``n_quoted`` its quoted lines, ``n_linked`` its runs with a known original, ``chat`` the
    text with its role around it. A reply comes after what it answers. Null texts are empty
    ones, a null role is ``unknown``; a message without conversation or turn links to nothing.
    Rows that share both stay separate rows of one place. Other columns are not read.
    """
    best = F.max_by("original", F.struct(-F.col("level"), "original"))
    links = quote_links(messages, conv, turn, text)
    replies = staged(
        links.groupBy(conv, turn).agg(best.alias("reply_to"), F.count("*").alias("n_linked")), "replies"
    )
    ways = replies.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col("reply_to").alias("thread"), F.lit(1).cast("long").alias("depth"))
    while True:
        further = ways.select("conv", F.col("turn").alias("thread"), F.col("thread").alias("above"), F.col("depth").alias("more"))
        jumped = staged(ways.join(further, ["conv", "thread"], "left"), "threads")
        ways = jumped.select(
            "conv",
            "turn",
            F.coalesce("above", "thread").alias("thread"),
            (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
        )
        if jumped.where("above is not null").isEmpty():
            break
    threads = ways.withColumnsRenamed({"conv": conv, "turn": turn})
    speaker = F.coalesce(messages[role].cast("string"), F.lit("unknown"))
    rows = messages.select(messages[conv], messages[turn], speaker.alias("role"), parsed_lines(messages[text]).alias("_lines"))
    rows = rows.select(
        conv,
        turn,
        "role",
        F.size(F.filter("_lines", lambda p: p["level"] > 0)).cast("long").alias("n_quoted"),
        own_text(F.col("_lines")).alias("text"),
    )
    return (
        rows.join(replies, [conv, turn], "left")
        .join(threads, [conv, turn], "left")
        .select(
            conv,
            turn,
            "role",
            "reply_to",
            F.coalesce("thread", turn).alias("thread"),
            F.coalesce("depth", F.lit(0).cast("long")).alias("depth"),
            "n_quoted",
            F.coalesce("n_linked", F.lit(0).cast("long")).alias("n_linked"),
            "text",
            F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("<|end|>\n")).alias("chat"),
        )
        .orderBy(conv, "thread", turn)
    )


def oracle() -> str:
    """The query on ``conversations`` as DuckDB SQL."""
    normal = f"trim(regexp_replace(lower(part), '{_SPACE}+', ' ', 'g'))"
    return f"""
WITH RECURSIVE numbered AS (
  SELECT row_number() OVER () AS id, conv_id, turn, coalesce(role, 'unknown') AS role,
         string_split(coalesce(text, ''), chr(10)) AS lines
  FROM conversations),
lines AS (
  SELECT id, conv_id, turn, unnest(lines) AS line, generate_subscripts(lines, 1) AS n FROM numbered),
marked AS (
  SELECT *, regexp_extract(line, '{_MARKS}') AS marks,
         length(regexp_replace(regexp_extract(line, '{_MARKS}'), '[^>]', '', 'g')) AS raw
  FROM lines),
leveled AS (
  SELECT id, conv_id, turn, n, substr(line, length(marks) + 1) AS body,
         CASE WHEN raw = 0 AND coalesce(lead(raw) OVER (PARTITION BY id ORDER BY n), 0) > 0
                   AND regexp_matches(line, '{_INTRODUCES}') THEN -1 ELSE raw END AS level
  FROM marked),
changes AS (
  SELECT *, CASE WHEN level IS DISTINCT FROM lag(level) OVER (PARTITION BY id ORDER BY n) THEN 1 ELSE 0 END AS new FROM leveled),
grouped AS (SELECT *, sum(new) OVER (PARTITION BY id ORDER BY n) AS run FROM changes),
runs AS (
  SELECT id, conv_id, turn, run, any_value(level) AS level, string_agg(body, chr(10) ORDER BY n) AS text
  FROM grouped GROUP BY id, conv_id, turn, run),
owned AS (
  SELECT id, conv_id, turn, coalesce(trim(string_agg(body, chr(10) ORDER BY n) FILTER (WHERE level = 0), '{_ENDS}'), '') AS text, count(*) FILTER (WHERE level > 0) AS n_quoted
  FROM leveled GROUP BY id, conv_id, turn),
parts AS (
  SELECT id, conv_id, turn, run, level, 0 AS kind, text AS part FROM runs
  UNION ALL SELECT id, conv_id, turn, run, level, 1, unnest(string_split_regex(text, '{_BLANK}')) FROM runs
  UNION ALL SELECT id, conv_id, turn, run, level, 2, unnest(string_split(text, chr(10))) FROM runs
  UNION ALL SELECT id, conv_id, turn, 0, 0, 0, text FROM owned),
units AS (SELECT conv_id, turn, id, run, level, kind, {normal} AS said FROM parts WHERE {normal} <> ''),
first AS (SELECT conv_id, said, min(turn) AS original FROM units WHERE level = 0 GROUP BY ALL),
weighed AS (
  SELECT u.conv_id, u.turn, u.run, u.level, u.kind, f.original, sum(length(u.said)) AS size
  FROM units u JOIN first f ON u.conv_id = f.conv_id AND u.said = f.said AND f.original < u.turn
  WHERE u.level > 0 GROUP BY ALL),
links AS (
  SELECT conv_id, turn, run, level, original FROM weighed
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn, run, level ORDER BY kind, size DESC, original) = 1),
replies AS (
  SELECT conv_id, turn, original AS reply_to, count(*) OVER (PARTITION BY conv_id, turn) AS n_linked FROM links
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, original DESC) = 1),
ways AS (
  SELECT conv_id, turn, reply_to AS thread, 1::BIGINT AS depth FROM replies
  UNION ALL
  SELECT w.conv_id, w.turn, r.reply_to, w.depth + 1 FROM ways w JOIN replies r ON w.conv_id = r.conv_id AND w.thread = r.turn),
threads AS (SELECT conv_id, turn, min(thread) AS thread, max(depth) AS depth FROM ways GROUP BY ALL)
SELECT m.conv_id, m.turn, m.role, r.reply_to, coalesce(t.thread, m.turn) AS thread, coalesce(t.depth, 0) AS depth,
       o.n_quoted, coalesce(r.n_linked, 0) AS n_linked, o.text,
       '<|' || m.role || '|>' || chr(10) || o.text || '<|end|>' || chr(10) AS chat
FROM numbered m JOIN owned o ON m.id = o.id
LEFT JOIN replies r ON m.conv_id = r.conv_id AND m.turn = r.turn
LEFT JOIN threads t ON m.conv_id = t.conv_id AND m.turn = t.turn"""
