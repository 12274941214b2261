"""Operator 3: benchmark decontamination by template canonicalisation.

Texts become token sequences in which numbers, names (capitalised words inside a
sentence, and the same word anywhere in that item) and units (after a number) are
typed placeholders and all else is lower-cased.  A capitalised word at the start of a
sentence may be a name or not: windows over one are hashed in both forms on both sides, so the
rest of a document never decides what its passage looks like; where the item takes it for a
literal, the document must hold the same word.  Every item window of ``window`` tokens
with at least ``literals`` literal ones is hashed; document windows that
pass a bit filter of fixed size, made of the benchmark's windows, are
hash-joined first with each item's rarest windows, one of which a contaminated document must hold,
then, for the pairs found, with all.  Item windows with fewer literal tokens are hashed over their
tokens as they stand, so a copy of them matches whatever they hold.  Along one alignment (document
place minus item place) the slots must be consistent: each of the item's values stands for one
value of the document (the one it meets at most places; its own in a tie), and windows
with another are dropped.  A document is contaminated by an item if
consistent alignments cover ``coverage`` of the item's windows, or of those with enough literal
tokens.  Items shorter than the window are one window of their own length (five tokens at least).

``kind`` is ``exact`` if all slots hold the item's own values, else ``reparameterised``.

Results for odd input: null and empty texts, and items under five tokens, match nothing;
a null item_id takes no part; rows repeating a doc_id are one document, rows without one are a
document a text; repeated items match alike; very long texts are read whole, in slices of a few; an empty table on either side gives no rows; further columns are ignored.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, slices, stage, table, tidy, worker_table, working_for

TOKEN = re.compile(r"\d+(?:[.,:/]\d+)*|[^\W\d_]+(?:['’-][^\W\d_]+)*|[.!?…\n%$€£]")
#: Unit names and symbols (fixed values).
UNITS = frozenset("""% $ € £ mm cm m km in ft yd mi inch inches foot feet yard yards mile miles metre metres meter meters
    kilometre kilometres kilometer kilometers centimetre centimetres centimeter centimeters mg g kg lb lbs oz gram grams
    kilogram kilograms pound pounds ounce ounces ton tons tonne tonnes ml l litre litres liter liters gallon gallons s sec
    second seconds min minute minutes h hr hour hours day days week weeks month months year years percent dollar dollars euro
    euros cent cents degree degrees kmh mph hz khz mhz ghz w kw v a j kj cal kcal""".split())
ENDS = frozenset(".!?…\n")
LITERAL, CAPITAL, NUMBER, UNIT, END = range(5)
PLACE = {NUMBER: "num", UNIT: "unit", CAPITAL: "name"}
LEAST, MAX_KNOWN, GROUP = 5, 1_000_000, 64
_MIX = np.uint64(0x9E3779B97F4A7C15)


def hash64(token: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(token.encode("utf-8", "replace"))


class Canon:
    """Tokens to kinds and hashes; a bounded table per worker."""

    def __init__(self):
        self.clear()
        self.place = {k: np.uint64(hash64(f"<{v}>")) for k, v in PLACE.items()}

    def clear(self) -> None:
        self.at: dict[str, int] = {}
        self.kind, self.hash, self.used = np.zeros(1024, np.int8), np.zeros(1024, np.uint64), 0

    def _new(self, token: str) -> int:
        if self.used == len(self.kind):
            self.kind, self.hash = np.concatenate([self.kind] * 2), np.concatenate([self.hash] * 2)
        low = token.lower()
        kind = (END if token in ENDS else NUMBER if token[0].isdigit() else UNIT if low in UNITS
                else CAPITAL if token[0].isupper() and (len(token) == 1 or not token.isupper()) else LITERAL)
        k = self.at[token] = self.used
        self.kind[k], self.hash[k] = kind, hash64(low)
        self.used += 1
        return k

    def templates(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens of all texts in turn without sentence marks, their hashes, their slot kind
        (LITERAL: none) by their text, with every capitalised word as a name, and with those that
        start a sentence as literals, and the number of their text."""
        if self.used > MAX_KNOWN:
            self.clear()
        tokens: list[str] = []
        sizes = []
        for text in texts:
            before = len(tokens)
            tokens += TOKEN.findall(text)
            tokens.append("\n")  # no sentence goes on in the next text
            sizes.append(len(tokens) - before)
        get, new = self.at.get, self._new
        ids = np.array([k if (k := get(t)) is not None else new(t) for t in tokens])
        of = np.repeat(np.arange(len(texts)), sizes)
        kind, hashes = self.kind[ids], self.hash[ids]
        end = kind == END
        capital = np.flatnonzero(kind == CAPITAL)
        inside = capital[~np.concatenate([[True], end[:-1]])[capital]]
        name = np.zeros(len(ids), bool)
        both = (of.astype(np.int64) << 32) | ids
        name[capital[np.isin(both[capital], both[inside])]] = True
        number = kind == NUMBER
        unit = (kind == UNIT) & np.concatenate([[False], number[:-1]])
        slot = np.where(number, NUMBER, np.where(unit, UNIT, np.where(name, CAPITAL, LITERAL))).astype(np.int8)
        named, plain = slot.copy(), slot.copy()
        named[capital] = CAPITAL
        plain[capital] = LITERAL
        plain[inside] = CAPITAL
        keep = np.flatnonzero(~end)
        return [tokens[k] for k in keep.tolist()], hashes[keep], slot[keep], named[keep], plain[keep], of[keep]

    def windows(self, hashes: np.ndarray, slot: np.ndarray | None, length: int) -> np.ndarray:
        """Hashes of the windows of ``length`` tokens, by place, with placeholders for ``slot``
        (None: of the tokens as they stand)."""
        n = max(0, len(hashes) - length + 1)
        h = np.full(n, np.uint64(length if slot is not None else length << 32))
        if slot is not None:
            hashes = hashes.copy()
            for k, x in self.place.items():
                hashes[slot == k] = x
        for k in range(length):
            h = (h ^ hashes[k:k + n]) * _MIX
            h ^= h >> np.uint64(29)
        return h


def enough(slot: np.ndarray, length: int, literals: int) -> np.ndarray:
    """By place, whether the window of ``length`` tokens has ``literals`` literal ones."""
    plain = np.concatenate([[0], np.cumsum(slot == LITERAL)])
    return plain[length:] - plain[:len(plain) - length] >= literals


_CANON: list[Canon] = []


def release() -> bool:
    """Drop this worker's table; whether there was one."""
    there = bool(_CANON)
    _CANON.clear()
    return there


worker_table("templates", release)


def canon() -> Canon:
    """One table per worker process; for a task that reads templates."""
    working_for("templates")
    if not _CANON:
        _CANON.append(Canon())
    return _CANON[0]


def slots_of(tokens: list[str], slot: np.ndarray, place: int, length: int, own: np.ndarray | None = None) -> list[str]:
    """Slot values of a window; names that are literals by ``own`` are ``same``."""
    return [f"{'same' if own is not None and own[i] == LITERAL else PLACE[int(slot[i])]}:{tokens[i].lower()}"
            for i in range(place, place + length) if slot[i] != LITERAL]


WINDOWS = "id long, place long, length long, h long, slots array<string>, offsets array<int>, templates long, n long"


def template_windows(rows: DataFrame, id_column: str, window: int, literals: int, bits: np.ndarray | None = None,
                     lengths: list[int] | None = None) -> DataFrame:
    """Windows of every text of ``rows``; with ``bits`` only those the filter lets pass.
    ``n`` is the number of window places of the text, ``templates`` of those with enough literal
    tokens; windows of the tokens as they stand have null ``slots``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = canon()
        schema = pa.schema([("id", pa.int64()), ("place", pa.int64()), ("length", pa.int64()), ("h", pa.int64()),
                            ("slots", pa.list_(pa.string())), ("offsets", pa.list_(pa.int32())), ("templates", pa.int64()), ("n", pa.int64())])
        for batch in slices(batches):
            out: dict[str, list] = {f: [] for f in schema.names}
            rows = [(i, t) for i, t in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()) if t and i is not None]
            step = GROUP if lengths else 1
            for k in range(0, len(rows), step):
                group = rows[k:k + step]
                tokens, hashes, slot, named, plain, of = c.templates([t for _, t in group])
                first = np.searchsorted(of, np.arange(len(group)))
                for length in lengths or [min(window, len(tokens))]:
                    if length < LEAST or length > len(tokens):
                        continue
                    fits = literal = bare = of[:len(of) - length + 1] == of[length - 1:]
                    if bits is None:  # a document's window is what the item's window is
                        rich = enough(slot, length, min(literals, -(-length // 2)) if length < window else literals)
                        literal, bare = fits & rich, fits & ~rich
                    n, templates = (np.bincount(of[:len(x)][x], minlength=len(group)) for x in (fits, literal))
                    known: list[np.ndarray] = []
                    for form in (slot, named, None) if bits is None else (named, plain, slot, None):
                        h = c.windows(hashes, form, length)
                        hit = (bare if form is None else literal).copy()
                        for other in known:
                            hit &= h != other
                        known.append(h)
                        if bits is not None:
                            at = h % np.uint64(len(bits) * 8)
                            hit &= (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
                        places = np.flatnonzero(hit)
                        for place, x in zip(places.tolist(), h[places].view(np.int64).tolist()):
                            g = int(of[place])
                            values = offsets = None
                            if form is not None:
                                values = slots_of(tokens, form, place, length, slot if bits is None else None)
                                offsets = np.flatnonzero(form[place:place + length] != LITERAL).tolist()
                            for name, value in zip(out, (group[g][0], place - int(first[g]), length, x, values, offsets, int(templates[g]), int(n[g]))):
                                out[name].append(value)
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    return rows.select(F.col(id_column).cast("long").alias("id"), F.col("text").cast("string").alias("text")).mapInArrow(tidy(read, "templates"), WINDOWS)


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 8, literals: int = 5, coverage: float = 0.5,
                 filter_bits: int = 1 << 22) -> DataFrame:
    """doc_id, item_id, coverage, kind, first_place, last_place (template tokens), text_hash of every
    contaminated document and item; text_hash (xxhash64) tells documents without a doc_id apart."""
    bench = stage(template_windows(benchmark, "item_id", window, literals), "bench-windows")
    # a filter of fixed size: more benchmark windows only let more document windows pass to the join
    at = F.expr(f"cast(pmod(cast(h as decimal(20,0)) + if(h < 0, 18446744073709551616bd, 0bd), {filter_bits}) as long)")
    words = bench.select(at.alias("at")).groupBy(F.expr("at div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits"))
    marks = np.zeros(filter_bits // 64, np.int64)
    for r in words.collect():  # at most filter_bits / 64 rows
        marks[r["word"]] = r["bits"]
    lengths = sorted(r["length"] for r in bench.select("length").distinct().collect())  # window at most
    ids = F.col("doc_id").cast("long")
    named = matches(docs.select(ids.alias("doc_id"), "text").where("doc_id IS NOT NULL"), bench, marks.view(np.uint8), lengths, window, literals, coverage)
    out = named.withColumn("text_hash", F.lit(None).cast("long"))
    nameless = docs.select(ids.alias("doc_id"), F.col("text").cast("string").alias("text")).where("doc_id IS NULL AND text IS NOT NULL")
    if nameless.isEmpty():
        return out
    other = matches(nameless.select(F.xxhash64("text").alias("doc_id"), "text"), bench, marks.view(np.uint8), lengths, window, literals, coverage)
    return out.unionByName(other.withColumn("text_hash", F.col("doc_id")).withColumn("doc_id", F.lit(None).cast("long")))


def candidates(found: DataFrame, bench: DataFrame, coverage: float) -> DataFrame:
    """doc_id, item_id that can reach the coverage.  Of an item's ``n`` window places (or of its
    ``templates``) a document must hold ``ceil(coverage n)``, so at least one of the rarest
    ``n - ceil(coverage n) + 1``, rare by how many document windows there are: windows that many
    items and documents share propose no pair unless an item has little else."""
    often = found.groupBy("h", "length").agg(F.count(F.lit(1)).alias("times"))
    places = bench.join(often, ["h", "length"], "left").groupBy(F.col("id").alias("item_id"), "place").agg(
        F.sum(F.coalesce("times", F.lit(0))).alias("times"), F.max("n").alias("n"), F.max("templates").alias("templates"),
        F.max(F.col("slots").isNotNull().cast("int")).alias("template"))
    by = Window.partitionBy("item_id").orderBy("times", "place")  # rows of one item: its places
    rank, of_templates = F.row_number().over(by), F.sum("template").over(by.rowsBetween(Window.unboundedPreceding, 0))
    reach = lambda n: n - F.ceil(n * coverage - 1e-9) + 1
    total = F.count(F.lit(1)).over(Window.partitionBy("item_id"))
    rare = places.withColumns({"rank": rank, "template_rank": of_templates, "all": total}).where(
        (F.col("rank") <= reach(F.greatest("all", "n"))) | ((F.col("template") == 1) & (F.col("template_rank") <= reach(F.col("templates")))))
    probe = bench.select(F.col("id").alias("item_id"), "place", "h", "length").join(rare.select("item_id", "place"), ["item_id", "place"])
    return found.select("doc_id", "h", "length").join(probe.select("item_id", "h", "length").distinct(), ["h", "length"]).select("doc_id", "item_id").distinct()


def matches(docs: DataFrame, bench: DataFrame, bits: np.ndarray, lengths: list[int], window: int, literals: int, coverage: float) -> DataFrame:
    """``contaminated`` for documents with ids, against written benchmark windows."""
    found = stage(template_windows(docs, "doc_id", window, literals, bits, lengths).select(F.col("id").alias("doc_id"), "place", "length", "h", "slots"), "doc-windows")
    pairs = stage(candidates(found, bench, coverage), "bench-candidates")
    item = bench.select(F.col("id").alias("item_id"), F.col("place").alias("item_place"), "length", "h", F.col("slots").alias("item_slots"), "offsets", "templates", "n")
    same = F.expr("""slots is null and item_slots is null or size(slots) = size(item_slots)
        and forall(zip_with(item_slots, slots, (a, b) -> not startswith(a, 'same:') or substr(a, 6) = substr(b, 6)), x -> x)""")
    hits = stage(pairs.join(item, "item_id").join(found, ["doc_id", "h", "length"]).where(same), "bench-hits")
    hits = hits.withColumn("diagonal", F.col("place") - F.col("item_place"))
    line = ["doc_id", "item_id", "diagonal"]
    each = hits.select(*line, "item_place", "h", F.explode(F.arrays_zip("item_slots", "slots", "offsets")).alias("s")).select(
        *line, "item_place", "h", (F.col("item_place") + F.col("s.offsets")).alias("token"), F.col("s.item_slots").alias("theirs"),
        F.col("s.slots").alias("ours")).where("not startswith(theirs, 'same:')")
    pairs = each.groupBy(*line, "theirs", "ours").agg(F.countDistinct("token").alias("tokens"), F.count(F.lit(1)).alias("times"))
    # the document's value for each of the item's: at most tokens, the item's own in a tie
    best = pairs.groupBy(*line, "theirs").agg(F.max(F.struct("tokens", F.col("ours") == F.col("theirs"), "times", "ours")).getField("ours").alias("best"),
                                              F.count(F.lit(1)).alias("values")).where("values > 1").drop("values")
    clash = each.join(best, [*line, "theirs"]).where("ours != best").select(*line, "item_place", "h").distinct()
    changed = pairs.where(F.col("ours") != F.col("theirs")).select(*line).distinct().withColumn("changed", F.lit(True))
    good = hits.join(clash, [*line, "item_place", "h"], "left_anti").join(changed, line, "left")
    spot = good.groupBy("doc_id", "item_id", "item_place").agg(
        F.max("n").alias("n"), F.max("templates").alias("templates"), F.max(F.col("item_slots").isNotNull().cast("int")).alias("template"),
        F.min(F.coalesce("changed", F.lit(False))).alias("changed"),
        F.min("place").alias("low"), F.max(F.col("place") + F.col("length")).alias("high"))
    covered = F.greatest(F.count(F.lit(1)) / F.max("n"), F.try_divide(F.sum("template"), F.max("templates")))
    return spot.groupBy("doc_id", "item_id").agg(
        covered.alias("coverage"), F.when(F.max("changed"), "reparameterised").otherwise("exact").alias("kind"),
        F.min("low").alias("first_place"), F.max("high").alias("last_place")).where(F.col("coverage") >= coverage)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, as it stands or with other numbers, names and units."""
    return contaminated(documents(spark, sf_dir), table(spark, sf_dir, "benchmark")).drop("text_hash")
