"""Joins the detectors and the booking view are made of; every one plans as an equi-join that shuffles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import is_blank, squeeze, tokens
from tidemark.operators.merge import latest_per_id
from tidemark.operators.shuffled import shuffled

# Characters of the grams that substrings are looked up by; longer needles are checked in full afterwards.
GRAM_CHARS = 8
# Rows with equal cells that each of the heads with that cell meets in one task.
BLOCK = 1_000


def header_lines(head: DataFrame, line: DataFrame, key: str = "doc_entry") -> DataFrame:
    """Heads with their lines; heads without lines and lines without an item are left out."""
    return head.join(shuffled(line.where(F.col("item").isNotNull())), key, "inner")


# --- keys that may be spread over comma-separated cells -------------------------------------------------


def _tagged(tag: str, values: Column) -> Column:
    return F.transform(values, lambda v: F.struct(F.lit(tag).alias("tag"), v.alias("key")))


def _explode_keys(df: DataFrame, keep: list[str], *arrays: Column) -> DataFrame:
    filled = [F.coalesce(a, F.array().cast("array<struct<tag:string,key:string>>")) for a in arrays]
    found = F.explode(F.array_distinct(F.concat(*filled))).alias("_k")
    return df.select(*keep, found).select(*keep, "_k.tag", "_k.key").where(F.col("key").isNotNull())


def _whole(csv: Column) -> Column:
    # Text comparison in the source database ignores trailing spaces.
    return F.array(F.rtrim(csv))


def _carried(df: DataFrame, *columns: str) -> list[str]:
    """Those of the columns that ``df`` has; ``weight`` goes along wherever changes are joined."""
    return [c for c in (*columns, "weight") if c in df.columns]


def reference_keys(rows: DataFrame, csv: str = "pv_no", row_id: str = "booking_id") -> DataFrame:
    """(id, tag, key) of the row side of :func:`multivalue_join`."""
    rows = rows.where(F.col(row_id).isNotNull()).withColumnRenamed(row_id, "id")
    cell = F.col(csv)
    return _explode_keys(
        rows,
        _carried(rows, "id", "_ref"),
        _tagged("whole", _whole(cell)),
        _tagged("row_token", tokens(cell)),
        _tagged("head_token", _whole(cell)),
        _tagged("item", F.array(F.col("id"))),
    )


def cell_keys(head: DataFrame, csv: str = "pv_no") -> DataFrame:
    """(serial, tag, key) of what heads' own cells say."""
    cell = F.col(csv)
    return _explode_keys(
        head,
        _carried(head, "serial", "stamp", "_cell"),
        _tagged("whole", _whole(cell)),
        _tagged("row_token", _whole(cell)),
        _tagged("head_token", tokens(cell)),
    )


def head_keys(head: DataFrame, line: DataFrame, csv: str = "pv_no") -> DataFrame:
    """(serial, tag, key) of the head side of :func:`multivalue_join`; heads without lines still have keys."""
    keep = _carried(head, "serial", "stamp", "_cell")
    by_item = header_lines(head, line).select(*keep, F.lit("item").alias("tag"), F.col("item").alias("key"))
    return cell_keys(head, csv).unionByName(by_item)


def keyed_join(events: DataFrame, rows: DataFrame, keys: list[str], latest: bool = False) -> DataFrame:
    """(id, serial) of every event and row that share a key.

    With ``latest`` only each key's newest event is joined. The newest event of an id is the newest of its
    keys' newest, so a caller that keeps one event per id loses nothing, and a key held by many events and
    many rows costs their sum rather than their product.
    """
    if latest:
        events = latest_per_id(events, keys)
    return events.join(shuffled(rows), keys).select("id", "serial").distinct()


def multivalue_join(
    head: DataFrame,
    line: DataFrame,
    rows: DataFrame,
    csv: str = "pv_no",
    latest: bool = False,
    blanks: bool = True,
) -> DataFrame:
    """Rows whose reference equals the head's, or either of which lists the other, or whose id is a line item.

    Each alternative becomes a tag, so the disjunction is one equi-join on (tag, key). ``head`` carries
    ``serial`` (and ``stamp`` when ``latest``). Blank references equal each other, as in SQL, which pairs every blank
    head with every blank row unless ``latest``; with ``blanks`` False they match nothing.
    """
    if not latest:
        head, rows = _sole_cells(head, "serial", csv, "_cell"), _sole_cells(rows.where("booking_id IS NOT NULL"), "booking_id", csv, "_ref")
    heads, refs = head_keys(head, line, csv), reference_keys(rows, csv)
    if not blanks:
        heads = heads.where(~is_blank(F.col("key")))
    if latest:
        return keyed_join(heads, refs, ["tag", "key"], latest)
    # Of a head and a row that are alone, equal cells pair once: only the others have to be told apart.
    equal = F.coalesce(F.col("_cell") == F.col("_ref"), F.lit(False))
    # Two that meet by their own whole cells are such, so they are kept from meeting: refs by their own (1) meet only heads by another key.
    own = lambda cell: (F.col("tag") != "item") & F.coalesce(F.col("key") == F.col(cell), F.lit(False))
    zero, one = F.lit(0), F.lit(1)
    meeting = heads.withColumn("_met", F.explode(F.when(own("_cell") | (F.col("tag") == "item"), F.array(zero)).otherwise(F.array(zero, one))))
    met = meeting.join(shuffled(refs.withColumn("_met", F.when(own("_ref"), one).otherwise(zero))), ["tag", "key", "_met"])
    others = met.where(~equal).select("id", "serial").distinct()
    whole = heads.where("tag = 'whole'").select("serial", "_cell").where("_cell IS NOT NULL")
    return others.unionByName(_in_blocks(whole, refs.where("tag = 'whole'").select("id", "_ref").where("_ref IS NOT NULL")))


def _sole_cells(df: DataFrame, key: str, csv: str, name: str) -> DataFrame:
    """``df`` with its whole cell as ``name``, NULL where several rows have the same ``key`` or none is given."""
    repeated = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1")
    counted = df.join(shuffled(repeated), key, "left")
    return counted.withColumn(name, F.when(F.col(key).isNotNull() & F.col("_n").isNull(), F.rtrim(csv))).drop("_n")


def _in_blocks(heads: DataFrame, refs: DataFrame) -> DataFrame:
    """(id, serial) of equal cells. A cell's rows are dealt to blocks of about ``BLOCK``, so that no task makes all pairs of one that many have."""
    blocks = refs.groupBy(F.col("_ref").alias("_cell")).agg(F.count("*").alias("_n")).where(F.col("_n") > BLOCK)
    blocks = blocks.select("_cell", F.ceil(F.col("_n") / BLOCK).cast("int").alias("_blocks"))
    some = F.coalesce("_blocks", F.lit(1))
    dealt_refs = refs.withColumnRenamed("_ref", "_cell").join(shuffled(blocks), "_cell", "left")
    dealt_refs = dealt_refs.select("id", "_cell", F.pmod(F.xxhash64("id"), some).cast("int").alias("_block"))
    dealt_heads = heads.join(shuffled(blocks), "_cell", "left").select("serial", "_cell", F.explode(F.sequence(F.lit(0), some - 1)).alias("_block"))
    return dealt_heads.join(shuffled(dealt_refs), ["_cell", "_block"]).select("id", "serial")


def csv_refs(rows: DataFrame, columns: list[str], row_id: str = "booking_id") -> DataFrame:
    """(id, doc_num) for every readable document number in the listed cells; other tokens match nothing."""
    cells = F.flatten(F.array(*[F.coalesce(tokens(F.col(c)), F.array().cast("array<string>")) for c in columns]))
    numbers = F.transform(cells, lambda t: t.try_cast("bigint"))
    return (
        rows.where(~is_blank(F.col(row_id)))
        .select(F.col(row_id).alias("id"), *_carried(rows), F.explode(F.array_distinct(numbers)).alias("doc_num"))
        .where(F.col("doc_num").isNotNull())
    )


def csv_ref_join(rows: DataFrame, docs: DataFrame, columns: list[str], latest: bool = False) -> DataFrame:
    """(id, serial) of rows that list a document's number in any of ``columns``."""
    return keyed_join(docs, csv_refs(rows, columns), ["doc_num"], latest)


def payment_to_invoice(payment: DataFrame, payment_line: DataFrame, payable: DataFrame) -> DataFrame:
    """Payments with the number of each payable invoice they settle, as ``doc_num``.

    A payment line names its head's entry in ``doc_num`` and the invoice's in ``doc_entry``. Cheque lines only
    repeat rows, so they are not read; a payment without an invoice can match nothing.
    """
    lines = payment_line.select(F.col("doc_num").alias("_payment"), F.col("doc_entry").alias("_invoice"))
    invoices = payable.select(F.col("doc_entry").alias("_invoice"), F.col("doc_num").alias("doc_num"))
    heads = payment.withColumnRenamed("doc_entry", "_payment").withColumnRenamed("doc_num", "pay_num")
    return heads.join(shuffled(lines), "_payment").join(shuffled(invoices), "_invoice").drop("_payment", "_invoice")


def docnum_ref_join(head: DataFrame, rows: DataFrame, ref: str = "so_ref", latest: bool = False) -> DataFrame:
    """(id, serial) of rows whose text reference is the head's document number."""
    refs = rows.select(
        F.col("booking_id").alias("id"), F.col(ref).try_cast("bigint").alias("doc_num")
    ).where("id IS NOT NULL AND doc_num IS NOT NULL")
    return keyed_join(head, refs, ["doc_num"], latest)


# --- existence ------------------------------------------------------------------------------------------


def in_any(df: DataFrame, key: str, *sides: tuple[DataFrame, str]) -> DataFrame:
    """Rows whose key occurs in at least one side: one semi-join against the sides' keys."""
    keys = reduce(DataFrame.unionByName, [side.select(F.col(c).alias(key)) for side, c in sides])
    return df.join(shuffled(keys.distinct()), key, "left_semi")


def not_exists(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    return df.join(shuffled(other.select(F.col(other_key).alias(key))), key, "left_anti")


def not_in(df: DataFrame, key: str, other: DataFrame, other_key: str) -> DataFrame:
    """SQL ``NOT IN``: nothing at all when ``other`` holds a NULL, everything when it is empty.

    The built-in plan broadcasts the whole key side. Here the two facts about NULL are scalar subqueries that
    stop at the first row, and the rest is an ordinary anti-join.
    """
    keys = other.select(F.col(other_key).alias(key))
    nulls = keys.where(F.col(key).isNull()).limit(1).agg(F.count("*")).scalar()
    some = keys.limit(1).agg(F.count("*")).scalar()
    kept = df.where((nulls == 0) & (F.col(key).isNotNull() | (some == 0)))
    return kept.join(shuffled(keys), key, "left_anti").select(*df.columns)


def flag_exists(df: DataFrame, key: str, keys: DataFrame, name: str) -> DataFrame:
    """Existence as a column: whether the row's key is among ``keys`` (one column, any name)."""
    (column,) = keys.columns
    marks = keys.where(F.col(column).isNotNull()).distinct().select(F.col(column).alias("_hit"))
    return (
        df.join(shuffled(marks), F.col(key) == F.col("_hit"), "left")
        .withColumn(name, F.col("_hit").isNotNull())
        .drop("_hit")
    )


def valid_ref_or_blank(df: DataFrame, ref: str, live: DataFrame, live_key: str = "doc_entry") -> DataFrame:
    """``ref`` is kept when a live document has it as its number, and is '' otherwise."""
    name = "_live_ref"
    keyed = df.withColumn("_ref_number", F.col(ref).try_cast("bigint"))
    marked = flag_exists(keyed, "_ref_number", live.select(live_key), name)
    return marked.withColumn(ref, F.when(F.col(name), F.col(ref)).otherwise("")).drop("_ref_number", name)


# --- substrings -----------------------------------------------------------------------------------------


def _grams(text: Column, n: Column) -> Column:
    """Distinct slices of ``n`` characters; no more than the text has characters."""
    letters = F.split(text, "")
    starts = F.when(F.size(letters) >= n, F.sequence(F.lit(1), F.size(letters) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(letters, i, n), "")))


def contains_join(cells: DataFrame, cell: str, needles: DataFrame, needle: str, gram: int = GRAM_CHARS) -> DataFrame:
    """Distinct ``cell`` values whose squeezed text contains a trimmed needle; blank needles match nothing.

    A needle's grams (itself, if it is no longer than one) all stand in a text that contains it. One that has a gram in no cell
    is left out; every other is looked up by the gram that the fewest cells have. Cells go by digest until then: a cell
    costs rows in proportion to its length, and texts are only read again for needles longer than a gram. Squeezed cells hold no space
    or comma, so needles that do are left out.
    """
    length = lambda c: F.size(F.split(c, ""))
    wanted = (
        needles.select(F.trim(F.col(needle)).alias("_needle"))
        .where((F.col("_needle") != "") & (F.col("_needle") == squeeze(F.col("_needle"))))
        .distinct()
        .withColumn("_n", F.least(length(F.col("_needle")), F.lit(gram)))
    )
    lengths = wanted.agg(F.collect_set("_n")).scalar()
    texts = cells.where(F.col(cell).isNotNull()).select(cell).distinct().withColumn("_text", squeeze(F.col(cell)))
    texts = texts.where("_text != ''").withColumn("_cell", F.unhex(F.sha2(F.col(cell), 256)))
    held = texts.select("_cell", "_text", F.explode(lengths).alias("_n"))
    held = held.select("_cell", F.explode(_grams(F.col("_text"), F.col("_n"))).alias("_gram"))
    frequency = held.groupBy("_gram").agg(F.count("*").alias("_cells"))
    asked = wanted.withColumn("_all", _grams(F.col("_needle"), F.col("_n")))
    known = asked.select("_needle", F.size("_all").alias("_size"), F.explode("_all").alias("_gram")).join(shuffled(frequency), "_gram")
    rarest = known.groupBy("_needle", "_size").agg(F.count("*").alias("_known"), F.min(F.struct("_cells", "_gram")).alias("_rarest"))
    # A needle that is its own gram is found by equality; letters outside the basic plane are two halves here.
    whole = (F.length("_needle") <= gram) & (F.octet_length("_needle") == F.length("_needle"))
    chosen = rarest.where("_known = _size").select(F.col("_rarest._gram").alias("_gram"), F.when(~whole, F.col("_needle")).alias("_rest")).distinct()
    met = held.join(shuffled(chosen), "_gram").select("_cell", "_rest").distinct()
    found = texts.join(shuffled(met), "_cell").where(F.col("_rest").isNull() | F.contains("_text", "_rest"))
    return found.select(cell).distinct()


def token_hits(cells: DataFrame, cell: str, needles: DataFrame, needle: str) -> DataFrame:
    """Distinct ``cell`` values that list a needle as one of their tokens."""
    wanted = needles.select(F.trim(F.col(needle)).alias("_token")).where(F.col("_token") != "").distinct()
    listed = cells.where(F.col(cell).isNotNull()).select(cell).distinct()
    listed = listed.select(cell, F.explode(F.array_distinct(tokens(F.col(cell)))).alias("_token"))
    return listed.join(shuffled(wanted), "_token").select(cell).distinct()


def enrich_booking(
    base: DataFrame, billing: DataFrame, tp: DataFrame, pricing: DataFrame, partner: DataFrame
) -> DataFrame:
    """Bookings with their side rows and both partners; side columns are prefixed, fan-out is kept."""

    def side(df: DataFrame, prefix: str, key: str) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{prefix}_{c}" if c != key else f"_{prefix}") for c in df.columns])

    joined = base
    for df, prefix in ((billing, "billing"), (tp, "tp"), (pricing, "pricing")):
        joined = joined.join(shuffled(side(df, prefix, "booking_id")), F.col("booking_id") == F.col(f"_{prefix}"), "left")
    for prefix, key in (("client", "client_code"), ("carrier", "carrier_code")):
        joined = joined.join(shuffled(side(partner, prefix, "code")), F.col(key) == F.col(f"_{prefix}"), "left")
    return joined.drop(*[f"_{p}" for p in ("billing", "tp", "pricing", "client", "carrier")])


def assert_unique_key(df: DataFrame, key: str) -> DataFrame:
    """``df``, failing at run time if a non-NULL key occurs twice: for callers that must not fan out."""
    repeated = df.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").limit(1)
    many = repeated.agg(F.count("*")).scalar()
    message = F.lit(f"{key} is not unique")
    return df.where(F.when(many == 0, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
