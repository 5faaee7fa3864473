"""N-gram Jaccard join over a MinHash LSH forest."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.forest import Forest
from strata.llm.shared import row_key
from strata.llm.similarity import links

TREES = 16
DEPTH = 8
RECALL = 0.9999


def shingle_join(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    similarity: float = 0.8,
    words: int = 5,
    trees: int = TREES,
    depth: int = DEPTH,
    recall: float = RECALL,
) -> DataFrame:
    """Per row of ``docs``: ``_id``, ``_hash`` (of the text), ``class_id``, the smallest
    id reachable by links, ``n_links``, the number of other rows linked directly, and
    ``kept``, true for the rows of one id and text in each component.

    Two texts link if the Jaccard similarity of their shingles reaches ``similarity``.
    Words are split at white space, with A-Z in lower case; a text of fewer words than a
    shingle is one shingle. Each of ``trees`` tries holds signatures of ``depth`` minima.
    Texts meet where they share a prefix, shortened until pairs at the threshold are found
    with the wanted ``recall``; where many texts share a short prefix, it stays longer as
    long as the recall allows. Texts that meet are compared exactly. Memory is bounded by
    blocks, whatever a group holds.

    Null and blank texts link with nothing and are their own component. Repeated rows
    are linked copies and share ``kept``. A null id counts as the smallest, and is given
    as class only if the component has no other. Other columns are not read.
    """
    source = docs.select(*row_key(doc_id, text), F.col(f"`{text}`").alias("_text"))
    found = links(source, ["_id", "_hash"], Forest(trees, depth, recall, words, similarity))
    groups = found.classes.groupBy("root").agg(
        F.min("first").alias("winner"), F.min("lowest").alias("class_id")
    )
    known = found.classes.join(groups, "root").select("cls", "n_links", "winner", "class_id")
    return found.rows.join(known, "cls", "left").select(
        "_id",
        "_hash",
        F.when(F.col("cls").isNull(), F.col("_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        (
            F.col("cls").isNull()
            | F.col("winner").eqNullSafe(F.struct("_id", "_hash"))
        ).alias("kept"),
    )
