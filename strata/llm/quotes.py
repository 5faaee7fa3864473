"""Chat formatting by quotation linking, in DataFrame functions only: quoted passages are
joined to the messages that they come from."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.shared import kept
from strata.operators.order import add_row_number

# Fixed: a quoted line begins with one or more > marks, blanks between them.
MARKS = r"(?s)^[ \t]*((?:>[ \t]?)+)(.*)$"


def normal(text: Column) -> Column:
    """A passage as it is compared: no case, white space as one space."""
    return F.trim(F.regexp_replace(F.lower(text), r"[\s\x{a0}]+", " "))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), r"\r?\n")


def parse(text: Column) -> Column:
    """The passages of a message in order: level, the number of quote marks, and text. Lines
    of one level in a row are one passage; a line without text ends it."""
    lines = F.transform(
        _lines(text),
        lambda line: F.struct(
            F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 1), "[^>]", "")).alias("level"),
            F.when(line.rlike(MARKS), F.regexp_extract(line, MARKS, 2)).otherwise(line).alias("text"),
        ),
    )
    kind = "array<struct<level:int,text:string>>"

    def add(done: Column, line: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        joined = F.struct(
            last["level"].alias("level"), F.concat_ws("\n", last["text"], line["text"]).alias("text")
        )
        ends = F.trim(line["text"]) == ""
        grows = (F.size(done) > 0) & (last["level"] == line["level"]) & (last["text"] != "") & ~ends
        return (
            F.when(grows, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined)))
            .when(ends, F.concat(done, F.array(F.struct(line["level"].alias("level"), F.lit("").alias("text")))))
            .otherwise(F.concat(done, F.array(line)))
            .cast(kind)
        )

    folded = F.aggregate(lines, F.array().cast(kind), add)
    return F.filter(folded, lambda p: p["text"] != "")


def unquoted(text: Column) -> Column:
    """A message without its quoted lines; blank lines around what is left go too."""
    own = F.filter(_lines(text), lambda line: ~line.rlike(r"^[ \t]*>"))
    return F.regexp_replace(F.array_join(own, "\n"), r"^\s+|\s+\z", "")


def hashes(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.reverse(text), F.length(text)).alias("h2")]


def _line_hashes(text: Column) -> Column:
    """The lines of a passage that have words."""
    lines = F.filter(F.transform(F.split(text, "\n"), normal), lambda line: line != "")
    return F.transform(lines, lambda line: F.struct(*hashes(line))).alias("lines")


def _first(own: DataFrame, quoted: DataFrame) -> DataFrame:
    """The first turn of each conversation that has what is quoted in it as its own."""
    wanted = quoted.select("conv_id", "h1", "h2")
    own = own.select("conv_id", "h1", "h2", "turn").join(wanted, ["conv_id", "h1", "h2"], "left_semi")
    return own.groupBy("conv_id", "h1", "h2").agg(F.min("turn").alias("origin"))


def _with_line_origins(found: DataFrame, own: DataFrame) -> DataFrame:
    """``origin`` by lines where a quoted passage has none as a whole."""
    passage = ["conv_id", "turn", "message", "place"]
    rest = found.where("origin IS NULL").dropDuplicates(passage)
    lines = rest.select(*passage, F.explode("lines").alias("line")).select(*passage, "line.*")
    firsts = _first(own.select("conv_id", "turn", F.explode("lines").alias("line")).select("*", "line.*"), lines)
    counts = (
        lines.join(firsts, ["conv_id", "h1", "h2"])
        .where("origin < turn")
        .groupBy(*passage, "origin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = counts.groupBy(*passage).agg(F.max(F.struct("n", "origin"))["origin"].alias("_by_lines"))
    joined = found.drop("lines").join(best, passage, "left")
    return joined.withColumn("origin", F.coalesce("origin", "_by_lines")).drop("_by_lines")


def link_quotes(
    messages: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Per message: ``conv_id``, ``turn``, ``role``, ``text`` without quotes, ``n_quotes``
    (quoted passages), ``n_linked`` (those whose original is known), ``reply_to`` (the turn
    answered), ``thread`` (the turn the thread begins with), ``depth`` (replies since then)
    and ``position`` in the reply-ordered conversation: threads by their first turn, in
    each by depth and turn, so that an answer follows what it quotes.

    A passage is quoted from the first message of its conversation with the same normalised
    passage of its own; only an earlier one counts as original. If there is none, as where
    part of a passage is quoted, each line of it counts for the first message with that
    line, if it is an earlier one, and the message with most of its lines is the original,
    the latest of several. Outer quotes, of the lowest level, say what is answered; the
    latest such turn if there are several. Passages and lines meet by two hashes. Originals
    are reduced to one row per passage and line before they meet quotes, so what a third of
    all messages quote is no hot group; chains of replies are followed by pointer jumping,
    as many rounds as the logarithm of the longest.

    Messages without quotes are threads of their own. A null text is kept as null and has
    no passages; a null conversation or turn is never linked, and has a position by itself.
    Repeated rows are kept, with equal results. Other columns are not read.
    """
    rows = messages.select(
        F.col(f"`{conversation}`").alias("conv_id"),
        F.col(f"`{turn}`").alias("turn"),
        F.col(f"`{role}`").alias("role"),
        F.col(f"`{text}`").alias("raw"),
    )
    passages = kept(
        rows.where("conv_id IS NOT NULL AND turn IS NOT NULL AND raw IS NOT NULL")
        .select("conv_id", "turn", F.md5("raw").alias("message"), parse(F.col("raw")).alias("p"))
        .select("conv_id", "turn", "message", F.posexplode("p").alias("place", "p"))
        .withColumn("words", normal(F.col("p.text")))
        .where("words <> ''")
        .select("conv_id", "turn", "message", "place", "p.level", *hashes(F.col("words")), _line_hashes(F.col("p.text"))),
        "passages",
    )
    own, quoted = passages.where("level = 0"), passages.where("level > 0")
    origin = _first(own, quoted)
    found = quoted.join(origin, ["conv_id", "h1", "h2"], "left").withColumn(
        "origin", F.when(F.col("origin") < F.col("turn"), F.col("origin"))
    )
    found = _with_line_origins(found, own)
    key = ["conv_id", "turn", "message"]
    replies = kept(
        found.groupBy(*key).agg(
            F.countDistinct("place").alias("n_quotes"),
            F.countDistinct(F.when(F.col("origin").isNotNull(), F.col("place"))).alias("n_linked"),
            F.max(
                F.when(F.col("origin").isNotNull(), F.struct((-F.col("level")).alias("near"), "origin"))
            )["origin"].alias("reply_to"),
        ),
        "replies",
    )
    # A turn may have several messages; its thread is that of the latest turn answered.
    step = replies.where("reply_to IS NOT NULL").groupBy("conv_id", "turn").agg(F.max("reply_to").alias("up"))
    threads = _threads(step)
    answered = (
        rows.withColumn("message", F.md5("raw"))
        .join(replies, key, "left")
        .join(threads, ["conv_id", "turn"], "left")
        .select(
            "conv_id",
            "turn",
            "role",
            unquoted_or_null("raw"),
            F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"),
            F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
            "reply_to",
            F.coalesce("thread", "turn").alias("thread"),
            F.coalesce("depth", F.lit(0)).cast("bigint").alias("depth"),
        )
    )
    # A sort deals a long conversation out over tasks, which a window would not.
    order = ["conv_id", "thread", "depth", "turn", "role", "text"]
    numbered = add_row_number(answered, "_number", order)
    begins = numbered.groupBy("conv_id").agg(F.min("_number").alias("_begin"))
    a, b = numbered.alias("a"), begins.alias("b")
    return (
        a.join(b, F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")))
        .withColumn("position", F.col("_number") - F.col("_begin"))
        .select("a.*", "position")
        .drop("_number")
    )


def unquoted_or_null(name: str) -> Column:
    return F.when(F.col(name).isNotNull(), unquoted(F.col(name))).alias("text")


def _threads(step: DataFrame) -> DataFrame:
    """``thread`` and ``depth`` of every turn that answers another, by pointer jumping."""
    now = kept(
        step.select("conv_id", "turn", F.col("up").alias("thread"), F.lit(1).alias("depth")), "threads"
    )
    while True:
        up = now.select(
            "conv_id",
            F.col("turn").alias("thread"),
            F.col("thread").alias("_above"),
            F.col("depth").alias("_more"),
        )
        further = now.join(up, ["conv_id", "thread"], "left")
        new = kept(
            further.select(
                "conv_id",
                "turn",
                F.coalesce("_above", "thread").alias("thread"),
                (F.col("depth") + F.coalesce("_more", F.lit(0))).alias("depth"),
                F.col("_above").isNotNull().alias("moved"),
            ),
            "threads",
        )
        if not new.where("moved").limit(1).count():
            return new.drop("moved")
        now = new.drop("moved")
