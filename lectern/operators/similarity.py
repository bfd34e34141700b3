"""Vocabulary, sparse vectors and cosine similarity over ``tf_idf`` weights.

Weights are rows ``(key, word, doc_freq, tfidf, ...)``; write them first, since operators pass
over them several times. A word in every document weighs zero and is dropped from products,
which changes nothing. No weight is negative, so no similarity is.

Similarities are published to four places, and so compared, ranked and cut off.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.operators import blocks
from lectern.operators.numbering import numbered
from lectern.sources.scratch import written

# A target document of at most this many words is broadcast.
MAX_TARGET_WORDS = 200_000

# So many keys, of documents that are joined, are broadcast.
MAX_KEYS = 200_000

# Indices to a chunk of a vector.
CHUNK_SIZE = 65_536

PLACES = 4
LEAST_PUBLISHED = 10**-PLACES

# Documents that are first compared with all others in the search for the least similar pairs.
FIRST_DOCUMENTS = 32

# So few documents are multiplied word by word, without bounds: no word has more postings than this.
FEW_DOCUMENTS = 32

# Pairs worked out for each wanted one before the join for the most similar pairs.
SEEDS = 4

# A long posting list is cut into parts of this size, by bands of the length that is left.
POSTINGS_PER_PART = 20_000
MOST_PARTS = 200_000
LEFT_BANDS = 64

# Parts of a vector whose lengths bound a product, and what a length of 1 is as a whole number.
SKETCH = 64
SKETCH_SCALE = 32_000


def vocabulary(words: DataFrame) -> DataFrame:
    """``(word, index)``: the distinct words of a column ``word``, in order, numbered from 0."""
    return numbered(words.select("word").distinct(), ["word"])


def vocabulary_size(words: DataFrame) -> DataFrame:
    """One row: the number of distinct words, which are the vectors' dimensions."""
    return words.agg(F.count_distinct("word").alias("dimensions"))


def tfidf_vector_chunks(weights: DataFrame, key: str, chunk_size: int = CHUNK_SIZE) -> DataFrame:
    """``(key, chunk, indices, values)``: sparse vectors cut by ranges of ``chunk_size`` indices.

    Takes weights made ``with_index``. No row holds more than ``chunk_size`` entries, whatever a document holds.
    """
    entry = F.struct(F.col("index").cast("int").alias("index"), F.col("tfidf").alias("value"))
    return (
        weights.groupBy(key, F.floor(F.col("index") / chunk_size).cast("int").alias("chunk"))
        .agg(F.array_sort(F.collect_list(entry)).alias("entries"))
        .select(key, "chunk", F.col("entries.index").alias("indices"), F.col("entries.value").alias("values"))
    )


def tfidf_vectors(weights: DataFrame, key: str) -> DataFrame:
    """``(key, size, indices, values)``: one sparse vector per document, indices ascending.

    A row is as long as the document has distinct words, which one shuffle brings together. Where a document may hold a
    vocabulary, as a source does, take ``tfidf_vector_chunks``.
    """
    size = weights.agg((F.coalesce(F.max("index"), F.lit(-1)) + 1).cast("int")).scalar()
    entry = F.struct(F.col("index").cast("int").alias("index"), F.col("tfidf").alias("value"))
    return (
        weights.groupBy(key)
        .agg(F.array_sort(F.collect_list(entry)).alias("entries"))
        .select(
            key,
            size.alias("size"),
            F.col("entries.index").alias("indices"),
            F.col("entries.value").alias("values"),
        )
    )


def _unit_weights(weights: DataFrame, key: str) -> DataFrame:
    """``(key, word, doc_freq, unit)``: the weights of vectors scaled to length 1."""
    present = weights.where("tfidf != 0").select(key, "word", "doc_freq", "tfidf")
    norms = present.groupBy(key).agg(F.sqrt(F.sum(F.col("tfidf") ** 2)).alias("norm"))
    return present.join(norms, key).select(
        key, "word", "doc_freq", (F.col("tfidf") / F.col("norm")).alias("unit")
    )


def _named(units: DataFrame, key: str, number: int, *keep: str) -> DataFrame:
    return units.select(
        "word", F.col(key).alias(f"book{number}"), *[F.col(c).alias(f"{c}{number}") for c in keep]
    )


def _suffixes(weights: DataFrame, key: str, postings_per_part: int) -> DataFrame:
    """``(key, word, term, doc_freq, tfidf, long, unit, left)``, of which nothing is worked out that is not asked for.

    Words are taken from the rarest on; ``long`` are those in more than ``postings_per_part`` documents, the last
    ones. ``left`` is the length of a unit vector from a word on; the length after it follows from both. ``term`` is the
    word's number where the weights have it, or the word. One shuffle by document and one sort serve the vector's
    length and what is left of it.
    """
    term = "index" if "index" in weights.columns else "word"
    square = F.col("tfidf") ** 2
    whole = Window.partitionBy(key)
    # From the end on, as Spark adds up a frame that grows, but starts anew on one that shrinks.
    onward = whole.orderBy(F.desc("doc_freq"), F.desc("word")).rowsBetween(Window.unboundedPreceding, 0)
    cut = (
        weights.where("tfidf != 0")
        .select(key, "word", F.col(term).alias("term"), "doc_freq", "tfidf")
        .withColumn("squares", F.sum(square).over(onward))
        .withColumn("total", F.sum(square).over(whole))
    )
    return cut.select(
        key,
        "word",
        "term",
        "doc_freq",
        "tfidf",
        (F.col("doc_freq") > postings_per_part).alias("long"),
        (F.col("tfidf") / F.sqrt("total")).alias("unit"),
        F.sqrt(F.col("squares") / F.col("total")).alias("left"),
    )


def _parted(postings: DataFrame, key: str, least: float, postings_per_part: int) -> DataFrame:
    """Add ``part``, and ``partners``: the parts of the same word that a posting has to meet.

    The postings of a word with more than ``postings_per_part`` of them are cut by ``left`` into bands,
    and these by a hash into parts of that size. A part is known by its greatest ``left``: a posting meets only parts
    where the product reaches ``least``. The parts of the words so cut are broadcast, one array a word; their number is at
    most ``MOST_PARTS`` and a few for each such word, as parts grow with the postings from there on.
    """
    bands = postings.groupBy("word", F.floor(F.col("left") * LEFT_BANDS).cast("int").alias("band")).agg(
        F.count("*").alias("postings"), F.max("left").alias("longest")
    )
    total = bands.agg(F.sum("postings")).scalar()
    size = F.greatest(F.lit(postings_per_part), F.ceil(F.coalesce(total, F.lit(0)) / MOST_PARTS))
    hot = (
        bands.withColumn("salts", F.sequence(F.lit(0), F.ceil(F.col("postings") / size).cast("int") - 1))
        .groupBy("word")
        .agg(
            F.sum("postings").alias("postings"),
            F.flatten(
                F.collect_list(F.transform("salts", lambda salt: F.struct(_part(F.col("band"), salt).alias("part"), "longest")))
            ).alias("parts"),
            F.map_from_entries(F.collect_list(F.struct("band", F.size("salts")))).alias("salts"),
        )
        .where(F.col("postings") > size)
        .select("word", "parts", "salts")
    )
    band = F.floor(F.col("left") * LEFT_BANDS).cast("int")
    own = _part(band, F.pmod(F.xxhash64(key), F.try_element_at("salts", band)))
    within = F.filter("parts", lambda part: part["longest"] * F.col("left") >= least)
    alone = F.lit(0).cast("long")
    cut = F.col("parts").isNotNull()
    return (
        postings.join(F.broadcast(hot), "word", "left")
        .withColumn("part", F.when(cut, own).otherwise(alone))
        .withColumn("partners", F.when(cut, F.transform(within, lambda part: part["part"])).otherwise(F.array(alone)))
        .drop("parts", "salts")
    )


def _part(band: Column, salt: Column) -> Column:
    """One number for a band and a salt of it."""
    return band.cast("long") * (1 << 40) + salt.cast("long")


def _candidates(suffixes: DataFrame, key: str, least: float, postings_per_part: int) -> DataFrame:
    """``(book1, book2)``: pairs that can reach ``least``, found block by block.

    A block holds at most ``postings_per_part`` documents, and so no more postings of a word.
    """
    if isinstance(suffixes.schema["term"].dataType, T.StringType):
        numbers = vocabulary(suffixes).withColumnRenamed("index", "number")
        postings = suffixes.select(key, "word", "doc_freq", "tfidf").join(numbers, "word")
    else:
        postings = suffixes.withColumnRenamed("term", "number")
    return blocks.near_pairs(blocks.vectors(postings, key), key, least, postings_per_part)


def _within_bound(pairs: DataFrame, suffixes: DataFrame, key: str, least: float) -> DataFrame:
    """The pairs whose products can reach ``least`` by the lengths of their vectors in ``SKETCH`` parts.

    Words are dealt to the parts by a hash. In each part no more comes together than the product of the two lengths, which are
    rounded up to whole numbers, so that no pair is lost and a pair moves two bytes a part.
    """
    part = F.pmod(F.xxhash64("word"), F.lit(SKETCH))
    square = F.col("unit") ** 2
    lengths = [
        F.ceil(F.sqrt(F.coalesce(F.sum(F.when(part == number, square)), F.lit(0.0))) * SKETCH_SCALE).cast("short")
        for number in range(SKETCH)
    ]
    sketches = suffixes.groupBy(key).agg(F.array(*lengths).alias("sketch"))
    first, second = (sketches.select(F.col(key).alias(f"book{i}"), F.col("sketch").alias(f"sketch{i}")) for i in (1, 2))
    products = F.zip_with("sketch1", "sketch2", lambda one, other: one.cast("long") * other)
    bound = F.aggregate(products, F.lit(0).cast("long"), lambda total, product: total + product)
    return (
        pairs.join(first, "book1")
        .join(second, "book2")
        .where(bound >= least * SKETCH_SCALE**2)
        .select("book1", "book2")
    )


def _tiles(pairs: DataFrame, sizes: DataFrame, key: str, docs_per_tile: int, words_per_tile: int) -> DataFrame:
    """Add ``tile``: pairs that have documents in common share one, whatever their number.

    A document is labelled by the first one among itself and its partners, so that documents alike have few labels.
    The documents of a label are cut by a hash into parts of at most about ``docs_per_tile`` documents and
    ``words_per_tile`` words; a tile is a part on either side.
    """
    ends = pairs.select(F.inline(F.array(
        F.struct(F.col("book1").alias(key), F.col("book1").alias("label")),
        F.struct(F.col("book2").alias(key), F.col("book1").alias("label")),
    )))
    labels = ends.groupBy(key).agg(F.min("label").alias("label")).join(sizes, key)
    parts = F.ceil(F.greatest(F.count("*") / docs_per_tile, F.sum("words") / words_per_tile)).cast("int")
    labels = labels.join(labels.groupBy("label").agg(parts.alias("parts")), "label").select(
        key, F.struct("label", F.pmod(F.xxhash64(key), "parts").alias("part")).alias("side")
    )
    first, second = (labels.select(F.col(key).alias(f"book{i}"), F.col("side").alias(f"side{i}")) for i in (1, 2))
    return pairs.join(first, "book1").join(second, "book2").select("book1", "book2", F.struct("side1", "side2").alias("tile"))


def _wanted(pairs: DataFrame, key: str) -> DataFrame:
    return written(pairs.select(F.explode(F.array("book1", "book2")).alias(key)).distinct(), "wanted")


def _products(
    pairs: DataFrame,
    suffixes: DataFrame,
    key: str,
    chunk_size: int = CHUNK_SIZE,
    docs_per_tile: int = blocks.DOCS_PER_BLOCK,
    words_per_tile: int = blocks.WEIGHTS_PER_BLOCK,
) -> DataFrame:
    """``(book1, book2, dot)``: the whole products of the pairs' vectors.

    Vectors are multiplied in blocks of about ``docs_per_tile`` documents and ``words_per_tile`` words, which are broadcast one after
    the other. They are cut by a hash of the word, all into the same number of chunks, so that the longest has about
    ``chunk_size`` words in each.
    """
    pairs = written(pairs, "pairs")
    suffixes = suffixes.join(_broadcast_few(_wanted(pairs, key)), key, "left_semi")
    longest = suffixes.groupBy(key).agg(F.count("*").alias("words"))
    chunks = longest.agg(F.ceil(F.coalesce(F.max("words"), F.lit(1)) / chunk_size)).scalar()
    chunk = F.pmod(F.xxhash64("word"), chunks)
    vectors = (
        suffixes.groupBy(key, chunk.alias("chunk"))
        .agg(F.collect_list(F.struct("term", "unit")).alias("vector"))
        .select(key, "chunk", F.col("vector.term").alias("terms"), F.col("vector.unit").alias("units"))
    )
    partners = pairs.groupBy(F.col("book1").alias(key)).agg(F.collect_list("book2").alias("partners"))
    dots = blocks.products(vectors.join(partners, key, "left"), key, docs_per_tile, words_per_tile)
    return dots.groupBy("book1", "book2").agg(F.sum("dot").alias("dot"))


def _shared_products(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """``(book1, book2, dot)`` of the pairs ``book1 < book2`` that share a word, word by word."""
    return (
        _named(first, key, 1, "unit")
        .join(_named(second, key, 2, "unit"), "word")
        .where("book1 < book2")
        .groupBy("book1", "book2")
        .agg(F.sum(F.col("unit1") * F.col("unit2")).alias("dot"))
    )


def _are_few(weights: DataFrame, key: str) -> bool:
    # A sketch, which is a row for each task, tells many documents from few; only few are counted.
    rough = weights.agg(F.approx_count_distinct(key)).first()[0]
    return rough <= 4 * FEW_DOCUMENTS and weights.select(key).distinct().count() <= FEW_DOCUMENTS


def _broadcast_few(keys: DataFrame) -> DataFrame:
    """Written rows of a key, to be broadcast if there are at most ``MAX_KEYS``."""
    return F.broadcast(keys) if keys.limit(MAX_KEYS + 1).count() <= MAX_KEYS else keys


def pairwise_cosine(
    weights: DataFrame, key: str, min_similarity: float = 0.5, postings_per_part: int = POSTINGS_PER_PART
) -> DataFrame:
    """``(book1, book2, similarity)`` of the pairs ``book1 < book2`` of at least ``min_similarity``.

    The threshold is part of the question; without it the answer grows with the square of the
    documents. It also bounds the work. Words are taken from the rarest on. From the first word that two documents share, no
    more can come together than the product of the lengths that are left of their unit vectors. So postings
    of a word meet only where each length reaches the threshold: the
    first shared word of every similar pair is among them. They meet in blocks of documents, which are broadcast one after
    the other, so that neither pairs nor vectors are shuffled for it. Pairs whose products
    so far and greatest possible rest stay below the threshold go at once, and those whose vectors' lengths in many
    parts do. The others' vectors are multiplied whole, in blocks too.

    Few documents, as sources are, may each hold a vocabulary, which no task should sort alone. All their pairs are
    multiplied word by word.
    """
    if not min_similarity > 0:
        raise ValueError("min_similarity must be above 0")
    if _are_few(weights, key):
        units = _unit_weights(weights, key)
        dots = _shared_products(units, units, key)
    else:
        # Half a published place, so that rounding up to the threshold is not lost.
        least = max(min_similarity - LEAST_PUBLISHED / 2, LEAST_PUBLISHED / 4) * (1 - 1e-9)
        found = _candidates(_suffixes(weights, key, postings_per_part), key, least, postings_per_part)
        # Only the vectors of documents with a partner are sorted, and multiplied.
        met = weights.join(_broadcast_few(_wanted(found, key)), key, "left_semi")
        dots = _products(found, _suffixes(met, key, postings_per_part), key)
    # Rounding can lift the cosine of equal directions a little above 1.
    cosine = dots.select("book1", "book2", F.least("dot", F.lit(1.0)).alias("similarity"))
    return cosine.where(F.round("similarity", PLACES) >= min_similarity)


def _signed(weights: DataFrame, key: str) -> DataFrame:
    """``(key, words, sign0, sign1)``: equal for documents with the same vector, and only for these."""
    mixed = [F.xxhash64("word", "tfidf"), F.xxhash64("tfidf", "word")]
    return (
        weights.groupBy(key)
        .agg(
            F.count_if(F.col("tfidf") != 0).alias("words"),
            *[F.bit_xor(F.when(F.col("tfidf") != 0, m)).alias(f"sign{i}") for i, m in enumerate(mixed)],
        )
        # A document without any weight is like no other.
        .withColumn("sign1", F.when(F.col("words") > 0, F.col("sign1")).otherwise(F.xxhash64(key)))
    )


def similar_documents(weights: DataFrame, key: str, min_similarity: float = 0.8) -> DataFrame:
    """``(key, class_id, links)``, one row per document with weights.

    Documents with the same vector make a class, named by its first one; links counts all other
    documents of at least ``min_similarity``. Only the classes' first documents are paired, so copies,
    however many, cost one row each.
    """
    signs = written(_signed(weights, key), "signs")
    sign = ["words", "sign0", "sign1"]
    classes = written(signs.groupBy(*sign).agg(F.min(key).alias("class_id"), F.count("*").alias("members")), "classes")
    copies = written(signs.select(key).join(classes.select(F.col("class_id").alias(key)), key, "left_anti"), "copies")
    first = weights.where(F.col(key).isNotNull()).join(_broadcast_few(copies), key, "left_anti")
    pairs = pairwise_cosine(first, key, min_similarity)
    ends = pairs.select(F.inline(F.array(
        F.struct(F.col("book1").alias("class_id"), F.col("book2").alias("other")),
        F.struct(F.col("book2").alias("class_id"), F.col("book1").alias("other")),
    )))
    sizes = classes.select(F.col("class_id").alias("other"), "members")
    linked = ends.join(sizes, "other").groupBy("class_id").agg(F.sum("members").alias("outside"))
    inside = F.when(F.col("words") > 0, F.col("members") - 1).otherwise(F.lit(0))
    links = classes.join(linked, "class_id", "left").select(
        *sign, "class_id", (inside + F.coalesce("outside", F.lit(0))).cast("long").alias("links")
    )
    same = [signs[c].eqNullSafe(links[c]) for c in sign]
    return signs.join(links, same[0] & same[1] & same[2]).select(key, "class_id", "links")


def _published(similarities: DataFrame) -> DataFrame:
    return similarities.withColumn("similarity", F.round("similarity", PLACES))


def _first_copies(weights: DataFrame, key: str, n: int) -> DataFrame:
    """The weights of the ``n`` first documents of each class of equal vectors."""
    place = F.row_number().over(Window.partitionBy("words", "sign0", "sign1").orderBy(key))
    first = _signed(weights, key).withColumn("place", place).where(F.col("place") <= n)
    return weights.join(first.select(key), key, "left_semi")


def _bound_of_best(weights: DataFrame, key: str, n: int) -> float:
    """A similarity that at least ``n`` pairs reach, or the least published one.

    Of every word, the two documents where it weighs most are a pair; its products over all such words add up to no
    more than the pair's similarity. The best of these pairs are then worked out.
    """
    units = _unit_weights(weights, key)
    heavy = Window.partitionBy("word").orderBy(F.desc("unit"), key)
    tops = units.withColumn("place", F.row_number().over(heavy)).where("place <= 2")
    two = F.array_sort(F.collect_list(key))
    seeds = (
        tops.groupBy("word")
        .agg(two.alias("books"), F.product("unit").alias("product"))
        .where(F.size("books") == 2)
        .groupBy(F.col("books")[0].alias("book1"), F.col("books")[1].alias("book2"))
        .agg(F.sum("product").alias("reached"))
        .orderBy(F.desc("reached"))
        .limit(SEEDS * n)
    )
    seeds = F.broadcast(written(seeds.select("book1", "book2"), "seeds"))
    first = seeds.join(_named(units, key, 1, "unit"), "book1")
    second = seeds.join(_named(units, key, 2, "unit"), "book2")
    dots = first.join(second, ["book1", "book2", "word"]).groupBy("book1", "book2")
    best = dots.agg(F.sum(F.col("unit1") * F.col("unit2")).alias("dot")).orderBy(F.desc("dot")).limit(n).collect()
    # One place less, as sums in another order may be rounded to the next one.
    return max(round(best[-1].dot, PLACES) - LEAST_PUBLISHED, LEAST_PUBLISHED) if len(best) == n else LEAST_PUBLISHED


def most_similar_pairs(weights: DataFrame, key: str, n: int = 10) -> DataFrame:
    """The ``n`` highest pairs, ties by names; fewer where fewer are above 0.

    Pairs that share a heavy word give a bound that the answer reaches; one join with that threshold gives
    the answer. Of documents with the same vector, the ``n + 1`` first ones make all the pairs that can come out.
    Among ``FEW_DOCUMENTS`` no bound is needed.
    """
    if _are_few(weights, key):
        least = LEAST_PUBLISHED
    else:
        weights = written(_first_copies(weights, key, n + 1), "first-copies")
        least = _bound_of_best(weights, key, n)
    pairs = _published(pairwise_cosine(weights, key, least))
    return pairs.orderBy(F.desc("similarity"), "book1", "book2").limit(n)


def least_similar_pairs(
    weights: DataFrame, key: str, n: int = 10, first_documents: int = FIRST_DOCUMENTS
) -> DataFrame:
    """The ``n`` lowest pairs, ties by names.

    Pairs at 0 lead, in order of their names. Documents are taken by name in blocks, each block compared with
    all documents that follow. A document that reaches fewer than follow it has partners at 0; the first
    ``n`` such documents of a block hold its first ``n`` pairs at 0, found by an anti-join. As soon as there are ``n`` of
    them no later pair can come before. Blocks double, and no pair is compared twice; only where fewer than ``n`` pairs
    are at 0 are all compared. Of each block, at most ``n`` pairs at 0 and ``n`` above reach the driver.
    """
    units = _unit_weights(weights, key)
    keys = numbered(weights.select(key).distinct(), [key], "rank")
    others = keys.select(F.col(key).alias("book2"), F.col("rank").alias("rank2"))
    total = keys.count()
    schema = T.StructType(
        [
            T.StructField("book1", weights.schema[key].dataType),
            T.StructField("book2", weights.schema[key].dataType),
            T.StructField("similarity", T.DoubleType()),
        ]
    )
    lowest, at_zero, low = [], 0, 0
    while low < total - 1 and at_zero < n:
        high = min(low + first_documents, total - 1)
        block = keys.where((F.col("rank") >= low) & (F.col("rank") < high))
        # Where the block is all, both sides of the join are the same, and are shuffled once.
        wanted = units if high - low == total - 1 else units.join(block.select(key), key, "left_semi")
        dots = _shared_products(wanted, units, key).select("book1", "book2", F.least("dot", F.lit(1.0)).alias("similarity"))
        met = written(_published(dots).where("similarity > 0"), "met")
        reached = met.groupBy("book1").agg(F.count("*").alias("reached"))
        lacking = (
            block.select(F.col(key).alias("book1"), F.col("rank").alias("rank1"))
            .join(reached, "book1", "left")
            .where(F.coalesce("reached", F.lit(0)) < total - 1 - F.col("rank1"))
            .orderBy("rank1")
            .limit(n)
        )
        few = lacking.agg(F.collect_list(F.struct("book1", "rank1"))).scalar()
        zeros = (
            others.select("book2", "rank2", F.inline(few))
            .where("rank1 < rank2")
            .join(met, ["book1", "book2"], "left_anti")
            .select("book1", "book2", F.lit(0.0).alias("similarity"))
        )
        for pairs in (zeros, met):
            lowest += pairs.orderBy("similarity", "book1", "book2").limit(n).collect()
        at_zero = sum(row.similarity == 0 for row in lowest)
        low, first_documents = high, 2 * first_documents
    found = weights.sparkSession.createDataFrame(lowest, schema)
    return found.orderBy("similarity", "book1", "book2").limit(n)


def similarity_stats(weights: DataFrame, key: str) -> DataFrame:
    """One row: average, least and greatest similarity over all pairs of documents.

    No pair is made for the average: over unit vectors, the products of all pairs and of
    each with itself sum to the square of the summed vectors, word by word.
    """
    units = _unit_weights(weights, key)
    squares = units.groupBy("word").agg((F.sum("unit") ** 2).alias("square"))
    total = squares.agg(F.coalesce(F.sum("square"), F.lit(0.0))).scalar()
    own = units.agg(F.coalesce(F.sum(F.col("unit") ** 2), F.lit(0.0))).scalar()
    least = least_similar_pairs(weights, key, 1).agg(F.min("similarity")).scalar()
    greatest = most_similar_pairs(weights, key, 1).agg(F.max("similarity")).scalar()
    pairs = F.col("documents") * (F.col("documents") - 1) / 2
    return weights.agg(F.count_distinct(key).alias("documents")).select(
        F.when(pairs > 0, F.greatest((total - own) / 2, F.lit(0.0)) / pairs).alias("average_similarity"),
        least.alias("min_similarity"),
        F.when(pairs > 0, F.coalesce(greatest, F.lit(0.0))).alias("max_similarity"),
    )


def vector_stats(weights: DataFrame, key: str) -> DataFrame:
    """Per document: nonzero terms, their mean and greatest weight, and sparsity in percent.

    A document whose weights are all zero keeps a row of zeros. Weights made ``with_index`` number the words from 0, so
    that the greatest number tells the dimensions and no word is shuffled for them.
    """
    if "index" in weights.columns:
        dimensions = weights.agg(F.max("index") + 1).scalar()
    else:
        dimensions = vocabulary_size(weights).scalar()
    nonzero = F.when(F.col("tfidf") != 0, F.col("tfidf"))
    return (
        weights.groupBy(key)
        .agg(
            F.count(nonzero).alias("unique_terms"),
            F.coalesce(F.avg(nonzero), F.lit(0.0)).alias("mean_tfidf"),
            F.coalesce(F.max(nonzero), F.lit(0.0)).alias("max_tfidf"),
        )
        .withColumn("sparsity", (1 - F.col("unique_terms") / dimensions) * 100)
    )


def find_similar(weights: DataFrame, key: str, target: object, top_n: int = 5) -> DataFrame:
    """The ``top_n`` documents nearest ``target`` by cosine, ties by key.

    A document that shares no word with the target scores 0. Raises ``ValueError`` when
    the target has no weights. One pass gives products and norms together. The target's
    words are counted first, and broadcast unless there are more than ``MAX_TARGET_WORDS``.
    """
    is_target = F.col(key) == F.lit(target)
    wanted = weights.where(is_target).select("word", F.col("tfidf").alias("wanted"))
    words = wanted.limit(MAX_TARGET_WORDS + 1).count()
    if words == 0:
        raise ValueError(f"{target!r} not found")
    if words <= MAX_TARGET_WORDS:
        wanted = F.broadcast(wanted)
    square = F.col("tfidf") ** 2
    wanted_norm = wanted.agg(F.sqrt(F.sum(F.col("wanted") ** 2))).scalar()
    norms = F.sqrt(F.sum(square)) * wanted_norm
    dot = F.coalesce(F.sum(F.col("tfidf") * F.col("wanted")), F.lit(0.0))
    similarity = F.when(norms == 0, 0.0).otherwise(F.least(dot / norms, F.lit(1.0)))
    scored = (
        weights.where(~is_target)
        .select(key, "word", "tfidf")
        .join(wanted, "word", "left")
        .groupBy(key)
        .agg(similarity.alias("similarity"))
    )
    return _published(scored).orderBy(F.desc("similarity"), key).limit(top_n)
