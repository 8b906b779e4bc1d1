"""Benchmark decontamination by template canonicalisation.

Words become canonical: numbers, names and units turn into typed placeholders, all else is lower-cased and loses
its outer punctuation. Windows of canonical words are hashed and joined between corpus and benchmark, and so are windows
whose names stay words, so that a copy in other case is found. Hits on one diagonal (same shift between text and item)
form a run, and its slots must be consistent: equal values in the item stand for equal values in the text. A question
with other numbers or names is therefore still found.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tallyforge.llm.text import whole, words
from tallyforge.session import stored

# Placeholders, outer punctuation, units, and marks that end a sentence.
NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"
PUNCTUATION = ".,;:!?\"'()[]{}«»„“”¿¡*"
UNITS = (
    "mm cm m km in ft yd mi inches feet yards miles meters metres kilometers kilometres g kg mg lb lbs oz grams kilograms pounds ounces "
    "s sec min h hr seconds minutes hours days weeks months years l ml liters litres gallons % percent dollars euros cents usd eur "
    "kmh mph degrees celsius fahrenheit watts volts joules newtons"
).split()
SENTENCE_END = ".!?:"
WINDOW = 8
DIGITS = "one two three four five six seven eight nine".split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
SPELLED = [
    "zero", *DIGITS, *"ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split(), *TENS,
    *[f"{t}-{d}" for t in TENS for d in DIGITS], "hundred", "thousand", "million", "billion",
]


def _bare(word):
    return F.lower(F.btrim(word, F.lit(PUNCTUATION)))


def _let(function, **columns):
    """``function`` of named columns that are computed once, however often it reads them."""
    return F.transform(F.array(F.struct(*[c.alias(name) for name, c in columns.items()])), function)[0]


def _numeric(bare):
    """A word with a digit in front, or behind one sign or currency, or a spelled-out number."""
    first = F.ascii(bare)
    return F.when(first.between(97, 122), bare.isin(SPELLED)).when(first.between(48, 57), True).when(first.isin(*map(ord, "-+$€£")), bare.rlike(r"^[-+$€£]\d")).otherwise(bare.isin(SPELLED))


def canonical(tokens):
    """Canonical words, at the places of the words. Several words of one name stay several placeholders.

    A number has a digit, sign or currency in front, or is spelled out; a unit is a listed word after a number; a name
    starts with a capital, goes on in small letters, and does not start a sentence.
    """
    return _canonical_and_bare(tokens, lambda x: x)["c"]


def _canonical_and_bare(tokens, of):
    """``of`` each canonical word as ``c``, and the words ``b`` without case and outer punctuation."""
    number_, unit_, name_ = (of(F.lit(x)) for x in (NUMBER, UNIT, NAME))

    def place(box):
        w, raw, b, number = box["x"]["w"], box["x"]["raw"], box["x"]["b"], box["number"]

        def one(bare, i):
            old, own = F.get(w, i - 1), F.get(raw, i)
            before = F.coalesce(F.get(number, i - 1), F.lit(False))
            named = (i > 0) & ~before & (F.length(own) > 1) & (F.substring(own, 1, 1) != F.substring(bare, 1, 1)) & (F.substring(own, 2, 100) == F.substring(bare, 2, 100)) & ~F.right(old, F.lit(1)).isin(*SENTENCE_END)
            return (F.when(F.get(number, i), number_)
                    .when(before & bare.isin(UNITS), unit_)
                    .when((own != bare) & named, name_).otherwise(of(bare)))

        return F.struct(F.transform(b, one).alias("c"), b.alias("b"))

    lowered = lambda box: F.struct(box["w"].alias("w"), box["raw"].alias("raw"), F.transform(box["raw"], lambda x: F.lower(x)).alias("b"))
    # btrim() once for each word: both forms follow from it.
    forms = _let(lowered, w=tokens, raw=F.transform(tokens, lambda x: F.btrim(x, F.lit(PUNCTUATION))))
    counted = _let(lambda box: F.struct(box["x"].alias("x"), F.transform(box["x"]["b"], _numeric).alias("number")), x=forms)
    return _let(lambda box: place(box["y"]), y=counted)


def _literal(c):
    """Whether a canonical word is no placeholder."""
    return ~c.isin(NUMBER, NAME, UNIT)


def _named(c, w):
    """Canonical words whose names stay words: the same for a text in other case."""
    return F.zip_with(c, w, lambda a, x: F.when(a == NAME, _bare(x)).otherwise(a))


def _starts(n, k):
    return F.when(n >= k, F.sequence(F.lit(0), n - k)).otherwise(F.array().cast("array<int>"))


def _joined(h, k):
    """Hash of every ``k`` neighbours of an array of hashes that has at least ``k``."""
    return _let(lambda box: F.transform(F.sequence(F.lit(0), F.size(box["h"]) - k), lambda i: F.xxhash64(F.slice(box["h"], i + 1, k))), h=h)


def _hash(tokens):
    """Hash of a window of words."""
    return F.xxhash64(F.transform(tokens, lambda x: F.xxhash64(x)))


def _windows(tokens, sizes):
    """Array of (k, m, hashes) of a text: ``m`` windows of ``k`` words, at 0, 1, ...; and the hashes of their canonical words,
    then (where the text has names) of those with names as words, then (where it has so many numbers or units in a row)
    of plain words. Each part has ``m`` places; null where it adds nothing."""
    def of(box):
        c, b = box["x"]["c"], box["x"]["b"]
        n, none = F.size(c), F.array().cast("array<bigint>")
        name, number, unit = (F.xxhash64(F.lit(x)) for x in (NAME, NUMBER, UNIT))

        def with_names(own, k):
            d = F.zip_with(c, b, lambda a, x: F.when(a == name, F.xxhash64(x)).otherwise(a))
            return F.when(F.array_contains(c, name), F.zip_with(_joined(d, k), own, lambda x, y: F.when(x != y, x))).otherwise(none)

        def of_numbers(k):
            counted = lambda x: (x == number) | (x == unit)
            first = F.filter(F.transform(c, lambda x, i: F.when(counted(x), i)), lambda i: i.isNotNull())
            starts = F.filter(first, lambda p: (p <= n - k) & F.forall(F.slice(c, p + 1, k), counted))
            lines = lambda box: F.transform(F.sequence(F.lit(0), n - k), lambda i: F.when(F.array_contains(box["s"], i), _hash(F.slice(b, i + 1, k))))
            return F.when(F.array_contains(c, number), _let(lambda box: F.when(F.size(box["s"]) > 0, lines(box)).otherwise(none), s=starts)).otherwise(none)

        def all_of(k):
            parts = F.when(n >= k, _let(lambda box: F.concat(box["own"], with_names(box["own"], k), of_numbers(k)), own=_joined(c, k))).otherwise(none)
            return F.struct(F.lit(k).alias("k"), F.greatest(n - k + 1, F.lit(0)).alias("m"), parts.alias("hashes"))

        return F.array(*[all_of(k) for k in sizes])

    return _let(of, x=_canonical_and_bare(tokens, lambda x: F.xxhash64(x)))


def _lines(items, k):
    """One line per window and hash of the items. A window without literal words is known by its plain words alone."""
    starts = _starts(F.size("c"), k)
    placed = items.withColumn("usable", F.size(F.filter(starts, lambda i: F.exists(F.slice("c", i + 1, k), _literal))))
    placed = placed.withColumn("literals", F.size(F.filter("c", _literal))).select("item", "size", "usable", "literals", "c", "w", F.explode(starts).alias("item_at"))
    cut = placed.select("item", "size", "usable", "literals", "item_at", F.slice("c", F.col("item_at") + 1, k).alias("item_c"), F.slice("w", F.col("item_at") + 1, k).alias("item_w"))
    d = _named(F.col("item_c"), F.col("item_w"))
    hashes = F.array_compact(F.array(
        F.when(F.exists("item_c", _literal), _hash(F.col("item_c"))),
        F.when(F.exists(d, _literal), _hash(d)).otherwise(_hash(F.transform("item_w", _bare)))))
    return cut.select("*", F.lit(k).alias("k"), F.explode(F.array_distinct(hashes)).alias("hash")).dropDuplicates(["item", "size", "item_at", "item_c", "item_w", "hash"])


def _slots(c, w):
    """(place in the window, value) of each placeholder."""
    marked = F.transform(c, lambda x, i: F.when(~_literal(x), F.struct(i.alias("o"), _bare(F.get(w, i)).alias("v"))))
    return F.filter(marked, lambda x: x.isNotNull())


def _hit_windows(docs, known, key, text, most_broadcast):
    """The windows of texts whose hash is among ``known`` (k, hash), with their words: doc, text_hash, k, hash, at, c, w.

    All texts give their hashes only; texts that have a hit are read once more for the words.
    """
    rows = docs.select(F.col(key).alias("doc"), F.xxhash64(whole(F.col(text))).alias("text_hash"), F.col(text).alias("text"))
    sizes = sorted(r[0] for r in known.select("k").distinct().collect())  # at most ``window`` lines
    # Outer on purpose: for a plain explode Spark adds a filter on the size of the array, below the projections, which then
    # computes all windows of a text once more. The join drops the line of a text without windows.
    sized = rows.select("doc", "text_hash", F.explode_outer(_windows(words(F.col("text")), sizes)).alias("_h")).select("doc", "text_hash", "_h.*")
    lines = sized.select("doc", "text_hash", "k", "m", F.posexplode_outer("hashes").alias("place", "hash"))
    lines = lines.select("doc", "text_hash", "k", "hash", (F.col("place") % F.greatest("m", F.lit(1))).alias("at"))
    wanted = known.select("k", "hash").distinct()
    if known.count() <= most_broadcast:
        wanted = F.broadcast(wanted)
    hits = stored(lines.join(wanted, ["k", "hash"], "left_semi"), "hits")
    of_text = hits.groupBy("doc", "text_hash").agg(F.collect_set(F.struct("k", "hash", "at")).alias("hits")).withColumnsRenamed({"doc": "_doc", "text_hash": "_hash"})
    held = F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("text_hash") == F.col("_hash"))

    def cut(box):
        c, w = box["c"], box["w"]
        piece = lambda x, h: F.slice(x, h["at"] + 1, h["k"])
        return F.transform(box["hits"], lambda h: F.struct(h["k"].alias("k"), h["hash"].alias("hash"), h["at"].alias("at"), piece(c, h).alias("c"), piece(w, h).alias("w")))

    # A slice of an array as stored in a row first decodes all of it; the result of a transform is sliced in place.
    split = lambda box: _let(cut, hits=box["hits"], w=box["w"], c=canonical(box["w"]))
    found = rows.join(of_text, held).select("doc", "text_hash", F.explode_outer(_let(split, hits=F.col("hits"), w=words(F.col("text")))).alias("_h"))
    return found.select("doc", "text_hash", "_h.*")


def _found(docs, benchmark, key, text, item, item_text, window=WINDOW, least_run=13, least_literal=5, most_broadcast=2_000_000, by_stretch=False):
    """Runs that count: doc, text_hash, item, n_windows, first_word, changed; None without items. See ``find``."""
    items = benchmark.select(F.col(item).alias("item"), words(F.col(item_text)).alias("w")).dropDuplicates()
    # A text may lead up to the item in mid-sentence, where a capital makes a name: the first word counts both ways.
    inside = F.slice(canonical(F.concat(F.array(F.lit("x")), F.col("w"))), 2, F.size("w"))
    items = items.where(F.size("w") > 0).withColumn("size", F.size("w")).withColumn("c", F.explode(F.array_distinct(F.array(canonical(F.col("w")), inside))))
    items = stored(items, "items")
    sizes = sorted(r[0] for r in items.select(F.least("size", F.lit(window))).distinct().collect())  # at most ``window`` lines
    if not sizes:
        return None
    lines = reduce(lambda a, b: a.unionByName(b), [_lines(items.where(F.least("size", F.lit(window)) == k), k) for k in sizes])
    lines = stored(lines, "item-windows")
    hits = _hit_windows(docs, lines, key, text, most_broadcast).join(lines, ["k", "hash"])
    c, w, item_c, item_w = (F.col(x) for x in ("c", "w", "item_c", "item_w"))
    equal = lambda x, y: F.forall(F.zip_with(x, y, lambda a, b: a == b), lambda e: e)
    same = equal(c, item_c) | equal(_named(c, w), _named(item_c, item_w)) | equal(F.transform(w, _bare), F.transform(item_w, _bare))
    slots = F.zip_with(_slots(item_c, item_w), _slots(item_c, w), lambda a, b: F.struct(a["v"].alias("a"), b["v"].alias("b")))
    kept = F.filter(F.transform(item_w, lambda x, i: F.when(_bare(x) == _bare(F.get(w, i)), F.col("item_at") + i)), lambda x: x.isNotNull())
    found = hits.select("doc", "text_hash", "item", "size", "usable", "literals", "item_at", "at", "k", same.alias("same"), slots.alias("pairs"), kept.alias("kept"))
    shift = F.col("at") - F.col("item_at")
    by = ["doc", "text_hash", "item", "size", "shift", "k"]
    # One text may stand in a row many times: places are counted once. A run has no more windows than its item.
    runs = found.withColumn("shift", shift).groupBy(*by).agg(
        F.count_distinct(F.when(F.col("same"), F.col("item_at"))).alias("n_windows"), F.min(F.when(F.col("same"), F.col("at"))).alias("first_word"),
        F.max("usable").alias("usable"), F.min("literals").alias("literals"),
        F.collect_set(F.when(F.col("same"), F.struct("item_at", "pairs", "kept"))).alias("hits"))
    full = F.least(F.col("size"), F.lit(max(least_run, window))) - F.col("k") + 1
    # Windows of placeholders alone match by their plain words only; a copy with other values can't have them.
    need = F.when(F.col("usable") > 0, F.least(full, "usable")).otherwise(full)
    runs = runs.withColumns({"full": full, "need": need})

    def all_of(hits, name):
        return F.array_distinct(F.flatten(F.transform(hits, lambda h: h[name])))

    def counts(box):
        """Enough places, enough equal words, and one value in the text for each value of the item."""
        hits, pairs = box["hits"], all_of(box["hits"], "pairs")
        consistent = F.size(F.array_distinct(F.transform(pairs, lambda p: p["a"]))) == F.size(pairs)
        places = F.size(F.array_distinct(F.transform(hits, lambda h: h["item_at"])))
        return (places >= F.col("need")) & (F.size(all_of(hits, "kept")) >= F.least(F.lit(least_literal), F.col("literals"))) & consistent

    good = counts({"hits": F.col("hits")})
    if by_stretch:
        starts = F.array_distinct(F.transform("hits", lambda h: h["item_at"]))
        part = F.transform(starts, lambda s: F.struct(F.filter("hits", lambda h: (h["item_at"] >= s) & (h["item_at"] < s + F.col("full"))).alias("hits")))
        good = good | F.exists(part, counts)
    changed = F.exists(all_of(F.col("hits"), "pairs"), lambda p: p["a"] != p["b"])
    return runs.where((F.col("n_windows") >= F.col("need")) & good).select("doc", "text_hash", "item", "n_windows", "first_word", changed.alias("changed"))


def find(docs, benchmark, key="doc_id", text="text", item="item_id", item_text="text", **options):
    """Pairs of document and benchmark item: key, item, n_windows, first_word, slots_changed.

    A pair is reported when one shift has matching windows for a stretch of ``least_run`` words (13), or for the whole
    item if that is shorter, at least ``least_literal`` of their words (5; all literal words of an item with fewer) are
    equal, and the slots are consistent: over all hits of the shift, or with ``by_stretch`` over one stretch of
    ``least_run`` words. n_windows counts distinct places of the item that matched, first_word is the first matching
    word of the text (from 0), slots_changed tells that some value differs.

    Windows have ``window`` words (8); shorter items are searched as one window of their own length. Case never counts,
    but a name is known as one only where it is capitalised. A window of placeholders alone matches by its plain words,
    and copies with other values need not have it. Null or empty texts and items match nothing; a null item id is an id
    like any other. Repeated documents are reported once per pair. The hashes of benchmark windows (12 bytes
    each) are broadcast up to ``most_broadcast`` lines (2,000,000), else joined by shuffle.
    """
    runs = _found(docs, benchmark, key, text, item, item_text, **options)
    if runs is None:
        return docs.sparkSession.createDataFrame([], f"{key} {docs.schema[key].dataType.simpleString()}, item_id {benchmark.schema[item].dataType.simpleString()}, n_windows long, first_word long, slots_changed boolean")
    return runs.groupBy("doc", "item").agg(
        F.max("n_windows").cast("long").alias("n_windows"), F.min("first_word").cast("long").alias("first_word"), F.max("changed").alias("slots_changed"),
    ).select(F.col("doc").alias(key), F.col("item").alias("item_id"), "n_windows", "first_word", "slots_changed")


def clean(docs, benchmark, key="doc_id", text="text", item="item_id", item_text="text", **options):
    """The documents without those that contain a benchmark item; all columns and repeated rows stay.

    Of rows with one key only the texts with an item go; rows without a key can't be told apart and go together.
    """
    runs = _found(docs, benchmark, key, text, item, item_text, **options)
    if runs is None:
        return docs
    bad = runs.select(F.col("doc").alias("_bad"), F.col("text_hash").alias("_hash")).distinct()
    held = F.col(key).eqNullSafe(F.col("_bad")) & (F.col(key).isNull() | (F.xxhash64(whole(F.col(text))) == F.col("_hash")))
    return docs.join(bad, held, "left_anti")
