"""Benchmark decontamination as a prefix-filtered set join, in DataFrame
operations only.

A window is ``size`` consecutive words of a benchmark item. Containing a
window means containing all of its words, so one word of it is a sufficient
prefix: the rarest one in the corpus. Document words are joined with the
rarest word of each window; the word's offset in the window places the window
in the document, the positional and length bounds drop placements that do not
fit, and the words at the rest are compared one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusflow.llm.common import lower_ascii
from corpusflow.plans.strategy import materialize

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The windows are broadcast only up to this many words and bytes (of words and
#: item ids) in total; beyond it the shuffle path places them.
MAX_BROADCAST_WORDS = 4_000_000
MAX_BROADCAST_BYTES = 64_000_000


def words_of(text: Column) -> Column:
    """Words of the A-Z lower-cased text; null text has none."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def windows_of(items: DataFrame, size: int, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct ``(item_id, win)``: every run of ``size`` words of an item, or
    all words of a shorter one; an item without words has none."""
    w = items.select(F.col(id_col).cast("string").alias("item_id"), words_of(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    w = w.select("item_id", "w", F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - size, F.lit(0)))).alias("at"))
    return w.select("item_id", F.slice("w", F.col("at") + 1, F.lit(size)).alias("win")).distinct()


def rarest_words(docs: DataFrame, windows: DataFrame, text_col: str, small: bool) -> DataFrame:
    """(win, off, rare): for each distinct window its rarest word by the number
    of occurrences in all of ``docs`` (ties: the smaller word) and the word's
    first offset in the window."""
    vocab = windows.select(F.explode("win").alias("word")).distinct()
    tokens = docs.select(F.explode(words_of(F.col(text_col))).alias("word"))
    counts = tokens.join(F.broadcast(vocab) if small else vocab, "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    each = windows.select("win").distinct().select("win", F.posexplode("win").alias("off", "word"))
    n = F.coalesce("n", F.lit(0))
    # One row per word of the windows; a word that many windows hold is no hot
    # key if the counts are broadcast.
    first = each.join(F.broadcast(counts) if small else counts, "word", "left").groupBy("win").agg(F.min(F.struct(n.alias("n"), "word", "off")).alias("r"))
    return first.select("win", "r.off", F.col("r.word").alias("rare"))


def contamination(
    docs: DataFrame, items: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", max_broadcast_words: int = MAX_BROADCAST_WORDS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_words``, ``n_hit`` (words
    inside any occurrence of a window), ``n_items``, ``items_sha256`` (of the
    ids of items with occurring windows, sorted as strings, comma-joined) and
    ``contaminated``. ``keep`` names further columns of ``docs`` to return.

    Defined cases: a null or wordless text has no words and no hits; null or
    wordless items have no windows, items repeated under one id count once, a
    null item id is dropped; repeated document rows give repeated rows; empty
    tables give no rows or no hits; other columns are ignored.

    The corpus is scanned once for the word counts and once for the match. The
    match keeps one row per document plus the verified occurrences, so what is
    shuffled is small; a word that is frequent is never a join key unless a
    window consists of frequent words alone.
    """
    windows = materialize(windows_of(items.where(F.col(item_col).isNotNull()), size, item_col, item_text_col), "windows")
    weight = F.octet_length(F.array_join("win", " ")) + F.octet_length("item_id") + 8 * F.size("win")
    total = windows.agg(F.coalesce(F.sum(F.size("win")), F.lit(0)), F.coalesce(F.sum(weight), F.lit(0))).first()
    small = total[0] <= max_broadcast_words and total[1] <= MAX_BROADCAST_BYTES
    rare = materialize(rarest_words(docs, windows, text_col, small), "rarest")
    base = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("_doc"),
        *[F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)], words_of(F.col(text_col)).alias("_w"),
    )
    if not small:  # read twice below: the row numbers must agree
        base = materialize(base, "numbered")
    keys = ["_row", "_doc", *[f"_keep_{i}" for i in range(len(keep))]]
    # Position -1 stands for the document itself, so that one pass gives both
    # its word count and its matches.
    tokens = base.select(*keys, "_w", F.posexplode(F.concat(F.array(F.lit(None).cast("string")), F.col("_w"))).alias("_i", "_t"))
    if small:
        by_win = windows.groupBy("win").agg(F.collect_set("item_id").alias("ids"))
        table = rare.join(by_win, "win").select("win", "off", "rare", "ids")
        m = tokens.join(F.broadcast(table), F.col("_t") == F.col("rare"), "left")
        start = F.col("_i") - 1 - F.col("off")
        fits = (start >= 0) & (start + F.size("win") <= F.size("_w"))
        same = F.slice("_w", F.greatest(start + 1, F.lit(1)), F.size("win")) == F.col("win")
        hits = m.where((F.col("_i") == 0) | (fits & same)).select(
            *keys, F.when(F.col("_i") == 0, F.size("_w")).alias("n"), F.when(F.col("_i") > 0, start).alias("s"),
            F.when(F.col("_i") > 0, start + F.size("win")).alias("e"), F.when(F.col("_i") > 0, F.col("ids")).alias("ids"),
        )
    else:
        hits = _placed(base, tokens, windows, rare, keys)
    return _summary(hits, keys, keep)


def _placed(base: DataFrame, tokens: DataFrame, windows: DataFrame, rare: DataFrame, keys: list[str]) -> DataFrame:
    """The same rows with the windows on a shuffled side: place by (rarest
    word), then compare word by word through equi-joins, without moving texts."""
    words = tokens.select("_row", (F.col("_i") - 1).alias("_p"), F.col("_t")).where(F.col("_p") >= 0)
    wid = F.xxhash64("win")
    placed = words.join(rare, F.col("_t") == F.col("rare")).select(
        "_row", (F.col("_p") - F.col("off")).alias("s"), wid.alias("wid"), "win"
    ).where(F.col("s") >= 0)
    need = placed.select("_row", "s", "wid", F.size("win").alias("len"), F.posexplode("win").alias("o", "_t"))
    need = need.select("_row", "s", "wid", "len", (F.col("s") + F.col("o")).alias("_p"), "_t")
    good = need.join(words, ["_row", "_p", "_t"]).groupBy("_row", "s", "wid", "len").agg(F.count(F.lit(1)).alias("c"))
    ids = windows.groupBy("win").agg(F.collect_set("item_id").alias("ids")).select(wid.alias("wid"), "ids")
    good = good.where(F.col("c") == F.col("len")).join(ids, "wid").select(
        "_row", F.lit(None).cast("int").alias("n"), "s", (F.col("s") + F.col("len")).alias("e"), "ids"
    )
    rest = [k for k in keys if k != "_row"]
    heads = base.select(*keys, F.size("_w").alias("n"), F.lit(None).cast("int").alias("s"), F.lit(None).cast("int").alias("e"),
                        F.lit(None).cast("array<string>").alias("ids"))
    found = heads.select(*keys).join(good, "_row").select(*keys, "n", "s", "e", "ids")
    assert rest
    return heads.unionByName(found)


def _summary(hits: DataFrame, keys: list[str], keep: tuple[str, ...]) -> DataFrame:
    """Union length of the occurrence intervals and the set of items, per row.
    A row's occurrences are at most its words times the window lengths."""
    before = F.max("e").over(Window.partitionBy("_row").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1))
    spans = hits.withColumn("new", F.when(F.col("s").isNotNull(), F.greatest(F.col("e") - F.greatest(F.col("s"), F.coalesce(before, F.lit(0))), F.lit(0))))
    rest = [k for k in keys if k != "_row"]
    # The row that stands for the document carries its columns.
    own = [F.max(F.when(F.col("n").isNotNull(), F.col(k))).alias(k) for k in rest]
    g = spans.groupBy("_row").agg(
        *own, F.max("n").cast("long").alias("n_words"), F.coalesce(F.sum("new"), F.lit(0)).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("ids")))).alias("items"),
    )
    return g.select(
        F.col("_doc").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
        *[F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)],
    )
