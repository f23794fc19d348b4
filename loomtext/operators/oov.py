"""Words that match nothing: frequency, dispersion, categories, order, roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.functions.strings import percent

# --- Fixed values: they decide a word's category. ---
PREVERBS = ["მი", "მო", "გა", "გამო", "გადა", "შე", "შემო", "ა", "აღ", "და", "ჩა", "ჩამო", "წა", "წამო", "ზე", "ზემო", "გარდა", "გარე", "თა", "სრ", "სულ"]
VERB_ENDINGS = [
    "ებ", "ოდ", "ავ", "ევ", "ვარ", "ხარ", "არს", "ვართ", "ართ", "არიან", "ვიყ", "იყ", "იყო", "ეყო", "დეს", "ნეს", "ოდეს", "ავდ", "ევდ", "ოდი",
    "ავდი", "ევდი", "ვიდ", "იდ", "ედ", "ოდით", "ავდით", "ვიდეთ", "იდეთ", "ედით", "ნნ", "ნენ", "ვდეთ", "ვდით", "ოდეთ",
]
FUNCTION_WORDS = [
    "და", "თუ", "ანუ", "ვითარ", "ვინ", "რამეთუ", "ამისთჳს", "ესე", "იგი", "მან", "მას", "მათ", "ჩუენ", "თქუენ", "ვინმე", "რაჲ", "არარაჲ", "არარა", "არარ",
    "სადა", "ოდეს", "ვიდრე", "ვიდრემდე", "ვითარცა", "ვინაჲთგან", "ეგე", "ამა", "ამის", "მისა", "მისგან", "მათგან", "ჩუენგან", "თქუენგან",
]
NAME_STEMS = [
    "პეტრ", "პავლ", "იოან", "იაკობ", "მარიამ", "ბასილ", "ეფრემ", "ათანას", "კირილ", "მოსე", "დავით", "სოლომონ", "ისაი", "იერემი", "ეზეკიელ", "ანტიოქ",
    "იოსებ", "აბრაამ", "ნინო", "გიორგ", "თეოდორ", "მიხეილ", "გაბრიელ", "მიქაელ", "სარა", "სიმეონ", "ზაქარი", "ელისაბედ", "ლაზარ", "ბართლომ", "ანდრი",
]
CATEGORIES = ["REVIEW", "VERB", "FUNCTION", "RARE"]
# --- End of fixed values. ---


def types(words: DataFrame, text: str = "text_id", order: str | None = None, with_texts: bool = False) -> DataFrame:
    """(surface, norm, freq, text_count, first_seen[, texts]) per surface of ``words``; norm is the last seen in ``order``.

    ``with_texts`` gathers a word's text ids in its row, as many as there are texts with it: for small corpora only, ``text_bitmaps`` for others. Counts go through (surface, text) pairs, so a word of every text is combined per text before it meets itself.
    """
    seen = F.col(order) if order else F.lit(0)
    pairs = words.groupBy("surface", text).agg(F.count("*").alias("n"), F.max_by("norm", seen).alias("norm"), F.max(seen).alias("last"), F.min(seen).alias("first"))
    aggs = [F.max_by("norm", "last").alias("norm"), F.sum("n").alias("freq"), F.count(text).alias("text_count"), F.min("first").alias("first_seen")]
    return pairs.groupBy("surface").agg(*aggs, *([F.array_sort(F.collect_list(text)).alias("texts")] if with_texts else []))


def text_types(docs: DataFrame, doc: str = "text_id", text: str = "text", word: str = r"\p{L}+") -> DataFrame:
    """(surface, freq, text_count) from the texts themselves. A word's first occurrence in a text is told apart in its row, so that words are
    combined where they are and no (surface, text) pair is shuffled. Rows that share an id, which are looked for first, go through those pairs."""
    words = F.regexp_extract_all(text, F.lit(f"({word})"), F.lit(1))
    if docs.groupBy(doc).count().filter("count > 1").isEmpty():
        lists = docs.select(F.col(doc).isNotNull().alias("__named"), words.alias("__words"))
        each = lists.select("__named", F.size("__words").alias("__n"), F.posexplode(F.concat("__words", F.array_distinct("__words"))).alias("__at", "surface"))
        occurs = F.col("__at") < F.col("__n")  # what follows are the distinct words
        return each.groupBy("surface").agg(F.count_if(occurs).alias("freq"), F.count_if(~occurs & F.col("__named")).alias("text_count"))
    pairs = docs.select(doc, F.explode(words).alias("surface")).groupBy("surface", doc).agg(F.count("*").alias("n"))
    return pairs.groupBy("surface").agg(F.sum("n").alias("freq"), F.count(doc).alias("text_count"))


def text_bitmaps(words: DataFrame, text: str = "text_id", width: int = 64, *more: Column) -> DataFrame:
    """(surface, bucket, bits[, more aggregates]): which texts hold a word, as one number for each run of ``width`` (64 at most) text numbers that has any. Numbers are
    combined by ``or`` before and after the shuffle, so no row grows with the corpus and a word of every text makes no list; a bitmap
    of thousands of bits a row would waste them on the many words of few texts."""
    bucket, bit = F.floor(F.col(text) / width).cast("long"), F.pmod(F.col(text), F.lit(width)).cast("int")
    return words.groupBy("surface", bucket.alias("bucket")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("bits"), *more)


def texts_of(bitmaps: DataFrame, width: int = 64) -> DataFrame:
    """``text_bitmaps`` with texts in place of bits: the text numbers of each row, in order, ``width`` at most."""
    held = F.filter(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.getbit("bits", i) == 1)
    return bitmaps.withColumn("texts", F.transform(held, lambda i: F.col("bucket") * width + i)).drop("bits")


def text_total(words: DataFrame, text: str = "text_id") -> DataFrame:
    """One row: n_texts."""
    return words.agg(F.count_distinct(text).alias("n_texts"))


def texts_with_words(docs: DataFrame, doc: str = "text_id", text: str = "text", word: str = r"\p{L}") -> DataFrame:
    """One row: n_texts, the same from the texts themselves, of which no word is exploded."""
    return docs.filter(F.col(text).rlike(word)).agg(F.count_distinct(doc).alias("n_texts"))


def category(surface: Column, norm: Column, freq: Column, df: Column, n_texts: Column, preverbs=PREVERBS, endings=VERB_ENDINGS, known=FUNCTION_WORDS) -> Column:
    """A type's category by the first rule that holds."""
    third = F.floor(n_texts / 3)
    verb = surface.rlike("^(?:" + "|".join(preverbs) + ")") | surface.rlike("(?:" + "|".join(endings) + ")$")
    return (
        F.when(surface.isin(known) | norm.isin(known), "FUNCTION")
        .when((freq >= 10) & (df >= F.greatest(F.lit(15), third)), "FUNCTION")
        .when(verb & (freq >= 3), "VERB")
        .when((freq >= 5) & (df <= F.least(F.lit(15), third)), "REVIEW")
        .when((freq >= 3) & (df <= 5), "REVIEW")
        .otherwise("RARE")
    )


def categorised(found: DataFrame, n_texts: DataFrame, **lists) -> DataFrame:
    """Types with pct_texts (one decimal, as text) and category."""
    df = found.crossJoin(F.broadcast(n_texts))  # one row
    kind = category(F.col("surface"), F.col("norm"), F.col("freq"), F.col("text_count"), F.col("n_texts"), **lists)
    return df.withColumn("pct_texts", percent(F.col("text_count"), F.col("n_texts"))).withColumn("category", kind)


def rank(column: str = "category") -> Column:
    return F.array_position(F.array(*map(F.lit, CATEGORIES)), F.col(column))


def ordered(found: DataFrame) -> DataFrame:
    """By category, falling frequency, then order of appearance and surface."""
    return found.orderBy(rank(), F.desc("freq"), "first_seen", "surface")


def top(found: DataFrame, kind: str, k: int) -> DataFrame:
    """The ``k`` most frequent types of a category."""
    return found.filter(F.col("category") == kind).orderBy(F.desc("freq"), "surface").limit(k)


def rollup(found: DataFrame) -> DataFrame:
    """Per category: types, tokens, and their share of all unmatched tokens in per cent."""
    one = found.groupBy("category").agg(F.count("*").alias("types"), F.sum("freq").alias("tokens"))  # a row a category; their sum is the total, so types are matched once
    one = one.agg(F.sum("tokens").alias("total"), F.collect_list(F.struct("category", "types", "tokens")).alias("kinds")).select("total", F.inline("kinds"))
    return one.select("category", "types", "tokens", F.try_divide(F.col("tokens") * 100.0, "total").alias("share"))
