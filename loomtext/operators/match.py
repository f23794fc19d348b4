"""Matching tokens: the cascade over stop words, authority names and two dictionaries; scoped matching; coverage.

Only distinct (surface, norm) pairs meet the lookups; tokens get their pair's match by one more join, which
drops out where only counts are asked for.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.functions import georgian
from loomtext.functions.strings import leading_numbers

TIERS = ("stopword", "authority", "primary", "master", "none")
#: Types that are brought to the words are fewer than this: each is more than this fraction of all words.
OFTEN = 1_000_000
NO_MATCH = {"match_tier": "none", "match_id": "", "match_lemma": "", "match_def_ka": "", "match_source": "", "confidence": "none", "in_lexicon": "0"}


def authority_keys(people: DataFrame, places: DataFrame, normalise=georgian.normalise) -> DataFrame:
    """(key, xml_id, type, main_ka, entity) from (xml_id, type, main_ka, variants, ord): variant forms, raw and normalised;
    the last one wins, places after persons."""
    both = people.withColumn("entity", F.lit("person")).unionByName(places.withColumn("entity", F.lit("place")))
    forms = F.posexplode(F.flatten(F.transform("variants", lambda v: F.array(v, normalise(v)))))
    keyed = both.select("xml_id", "type", "main_ka", "entity", "ord", forms.alias("nth", "key")).filter("key <> ''")
    last = F.max_by(F.struct("xml_id", "type", "main_ka", "entity"), F.struct(F.col("entity") == "place", "ord", "nth"))
    return keyed.groupBy("key").agg(last.alias("x")).select("key", "x.*")


def _payload(lookup: DataFrame, tier: str) -> DataFrame:
    """(key, hit): what a dictionary's key gives."""
    has = set(lookup.columns)
    source = F.coalesce(*[F.col(c) for c in ("source", "source_id") if c in has], F.lit(""))
    if "tsv_supplements" in has:
        more = F.array_join(F.filter(F.transform("tsv_supplements", lambda s: s["source_id"]), lambda s: s != ""), "|")
        source = F.when(F.coalesce(more, F.lit("")) != "", F.concat(source, F.lit("+"), more)).otherwise(source)
    empty = F.lit("")
    return lookup.select(
        "key",
        F.struct(
            F.lit(tier).alias("match_tier"), F.col("xml_id").alias("match_id"), F.coalesce("lemma", empty).alias("match_lemma") if "lemma" in has else empty.alias("match_lemma"),
            F.left(F.coalesce("def_ka", empty), F.lit(120)).alias("match_def_ka") if "def_ka" in has else empty.alias("match_def_ka"),
            source.alias("match_source"), F.when(F.col("in_lexicon"), "1").otherwise("0").alias("in_lexicon") if "in_lexicon" in has else F.lit("0").alias("in_lexicon"),
        ).alias("hit"),
    )


def match_types(types: DataFrame, stopwords: DataFrame, authority: DataFrame, primary: DataFrame, master: DataFrame, tiers=("primary", "master"), each: bool = False) -> DataFrame:
    """(surface, norm, match_tier, match_id, match_lemma, match_def_ka, match_source, confidence, in_lexicon) for distinct pairs.

    The first that hits counts: stop word (either form), authority (surface, then norm), first dictionary
    by surface, second by surface, first by norm, second by norm, none. norm is tried only if it is
    given and differs. Each lookup is one row per key, so left joins never multiply; Catalyst broadcasts small ones.
    ``each`` matches every row, other columns kept, as a stream needs it.
    """
    df = types if each else types.select("surface", "norm").distinct()
    # a word without a norm of its own asks for its surface again: that changes nothing in the order below, and nulls would all meet in one task
    probe = F.when(F.col("norm") != "", F.col("norm")).otherwise(F.col("surface"))
    names = authority.select(
        "key",
        F.struct(
            F.lit("authority").alias("match_tier"), F.col("xml_id").alias("match_id"), F.coalesce("main_ka", F.lit("")).alias("match_lemma"), F.coalesce("type", F.lit("")).alias("match_def_ka"),
            F.concat(F.lit("authority/"), F.col("entity")).alias("match_source"), F.lit("0").alias("in_lexicon"),
        ).alias("hit"),
    )
    stop = stopwords.select(F.col("word").alias("key"), F.lit(True).alias("hit")).distinct()
    tables = {"s": stop, "auth": names, "a": _payload(primary, tiers[0]), "b": _payload(master, tiers[1])}
    # the lookups are laid side by side once, so a type meets them in two joins, by surface and by norm, and not in eight
    every = [t.select("key", *[(F.col("hit") if n == name else F.lit(None)).alias(f"__{n}") for n in tables]) for name, t in tables.items()]
    side = reduce(DataFrame.unionByName, every).groupBy("key").agg(*[F.first(f"__{n}", ignorenulls=True).alias(f"__{n}") for n in tables])
    for by, column in (("x", F.col("surface")), ("n", probe)):
        one = side.select(F.col("key").alias(f"__key{by}"), *[F.col(f"__{n}").alias(f"__{n}{by}_hit") for n in tables])
        df = df.join(one, column == F.col(f"__key{by}"), "left").drop(f"__key{by}")
    hit = lambda n, confidence: F.when(F.col(f"__{n}_hit").isNotNull(), F.struct(F.col(f"__{n}_hit").alias("h"), F.lit(confidence).alias("confidence")))
    found = F.coalesce(hit("authx", "exact"), hit("authn", "exact"), hit("ax", "exact"), hit("bx", "exact"), hit("an", "norm"), hit("bn", "norm"))
    df = df.withColumn("__m", found).withColumn("__stop", F.coalesce("__sx_hit", "__sn_hit", F.lit(False)))

    def out(name: str, stopped: Column) -> Column:
        got = F.col("__m.confidence") if name == "confidence" else F.col(f"__m.h.{name}")
        return F.when(F.col("__stop"), stopped).otherwise(F.coalesce(got, F.lit(NO_MATCH[name]))).alias(name)

    stopped = {"match_tier": F.lit("stopword"), "match_id": F.lit(""), "match_lemma": F.col("surface"), "match_def_ka": F.lit(""), "match_source": F.lit("stopwords"), "confidence": F.lit("stopword"), "in_lexicon": F.lit("0")}
    rest = [c for c in types.columns if c not in ("surface", "norm")] if each else []
    return df.select("surface", "norm", *rest, *[out(n, stopped[n]) for n in NO_MATCH])


def match_tokens(tokens: DataFrame, stopwords: DataFrame, authority: DataFrame, primary: DataFrame, master: DataFrame, tiers=("primary", "master")) -> DataFrame:
    """``tokens`` with their match."""
    return tokens.join(match_types(tokens, stopwords, authority, primary, master, tiers), ["surface", "norm"])


def tier_coverage(counted: DataFrame, by: str = "match_tier", n: str = "n") -> DataFrame:
    """(by, tokens, share): tokens per tier, or confidence, and their share of all in per cent; from counted types."""
    one = counted.groupBy(by).agg(F.sum(n).alias("tokens"))  # a row a tier; their sum is the total, so types are matched once
    one = one.agg(F.sum("tokens").alias("total"), F.collect_list(F.struct(by, "tokens")).alias("tiers")).select("total", F.inline("tiers"))
    return one.select(by, "tokens", F.try_divide(F.col("tokens") * 100.0, "total").alias("share"))


def counted(tokens: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    """Tokens counted per ``keys``, so that a frequent word meets its match once a text and not once a token."""
    return tokens.groupBy(*keys).agg(F.count("*").alias(n))


def text_coverage(matched: DataFrame, text: str = "text_id", n: str | None = None) -> DataFrame:
    """Per text: total tokens, matched ones (neither none nor stop word) and those in the lexicon; of tokens, or of rows
    that stand for ``n`` tokens each."""
    one = F.col(n) if n else F.lit(1).cast("long")
    sum_if = lambda c: F.sum(F.when(c, one).otherwise(0))
    return matched.groupBy(text).agg(
        F.sum(one).alias("total"), sum_if(~F.col("match_tier").isin("none", "stopword")).alias("matched"), sum_if(F.col("in_lexicon") == "1").alias("in_lex")
    )


def often(types: DataFrame, n: str = "freq", most: int = OFTEN) -> Column:
    """Whether a type of ``types`` (with its count ``n``) is more than 1/``most`` of all words: of fewer than ``most`` types, whatever the words are."""
    return F.col(n) > (types.agg(F.sum(n)).first()[0] or 0) / most


def words_coverage(words: DataFrame, types: DataFrame, text: str = "text_id", most: int = OFTEN) -> DataFrame:
    """``text_coverage`` of ``words`` (text, surface) by their ``types`` (surface, freq, match_tier, in_lexicon), which are read more than once. Types that come
    often are brought to the words, so that only words of the others are shuffled, and come back only if they count."""
    matched, in_lex = ~F.col("match_tier").isin("none", "stopword"), F.col("in_lexicon") == "1"
    kinds = types.select("surface", often(types, most=most).alias("__often"), matched.cast("long").alias("matched"), in_lex.cast("long").alias("in_lex"))
    many = kinds.filter("__often")
    near = words.join(F.broadcast(many), "surface", "left").select(text, F.lit(1).cast("long").alias("total"), "matched", "in_lex")
    rest = words.join(F.broadcast(many.select("surface")), "surface", "left_anti").join(kinds.filter("NOT __often AND matched + in_lex > 0"), "surface")
    both = near.unionByName(rest.select(text, F.lit(0).cast("long").alias("total"), "matched", "in_lex"))
    return both.groupBy(text).agg(F.sum("total").alias("total"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("matched", "in_lex")])


def name_candidates(oov: DataFrame, stems: list[str], least: int = 3, most_texts: int = 15) -> DataFrame:
    """Unmatched types (surface, norm, freq, text_count, texts) that are frequent, not too dispersed, and begin, raw or
    normalised, with a known name's stem."""
    starts = "^(?:" + "|".join(stems) + ")"
    return oov.filter((F.col("freq") >= least) & (F.col("text_count") <= most_texts) & (F.col("surface").rlike(starts) | F.col("norm").rlike(starts)))


def classify(words: DataFrame, primary: DataFrame, known: DataFrame, stem: str = "stem") -> DataFrame:
    """``words`` with class: ``new`` if the stem is in ``primary`` (key) and not ``known`` (key), ``known`` if it is, else ``unknown``."""
    a = primary.select(F.col("key").alias(stem), F.lit(True).alias("__a")).distinct()
    b = known.select(F.col("key").alias(stem), F.lit(True).alias("__b")).distinct()
    kind = F.when(F.col("__b"), "known").when(F.col("__a"), "new").otherwise("unknown")
    return words.join(a, stem, "left").join(b, stem, "left").withColumn("class", kind).drop("__a", "__b")


# --- Scoped matching ------------------------------------------------------------------------------


def page_texts(ranges: DataFrame, low: str = "from", high: str = "to") -> DataFrame:
    """(page, text_id): the text whose range (text_id, low, high, ord) holds a page; of several the first in order."""
    pages = ranges.filter(F.col(low).isNotNull()).select("text_id", "ord", F.explode(F.sequence(F.col(low), F.greatest(F.col(low), F.coalesce(high, low)))).alias("page"))
    return pages.groupBy("page").agg(F.min_by("text_id", "ord").alias("text_id"))


def scope(entries: DataFrame, pages: DataFrame) -> DataFrame:
    """(text_id, entry columns…): entries (with array pages) for each text that they cite a page of."""
    cited = entries.withColumn("page", F.explode("pages")).join(pages, "page").drop("page", "pages")
    return cited.dropDuplicates(["text_id", "ord"])


def cited_pages(cell: Column) -> Column:
    """Pages of a citation cell: the first number of each group."""
    return leading_numbers(cell)


def scoped_match(words: DataFrame, scoped: DataFrame, endings: list[str], least: int, tag: str = "xml_id", vowels: str = "[იჲ]$") -> DataFrame:
    """(text_id, surface, id, tier): for distinct words of each text the entry in its scope that they mean.

    Three tiers: an exact cleaned form, a normalised form, a stem with an ending (``forms`` array and
    ``base`` of the entry); the lowest tier wins, and in it the first entry. Stems are spelt out with their
    endings, so all three are one equality join on (text, form).
    """
    forms = F.concat(
        F.transform("forms", lambda f: F.struct(F.lit(0).alias("tier"), georgian.cleaned(f).alias("form"))),
        F.transform("forms", lambda f: F.struct(F.lit(1).alias("tier"), georgian.scoped_norm(f).alias("form"))),
        F.transform(georgian.stem_forms(georgian.cleaned(F.col("base")), endings, least, vowels), lambda f: F.struct(F.lit(2).alias("tier"), f.alias("form"))),
    )
    side = scoped.select("text_id", F.col(tag).alias("id"), "ord", F.explode(F.array_distinct(forms)).alias("x")).select("text_id", "id", "ord", "x.tier", "x.form").filter("form <> ''")
    side = side.groupBy("text_id", "tier", "form").agg(F.min(F.struct("ord", "id")).alias("e"))
    probe = F.explode(F.array(F.struct(F.lit(0).alias("tier"), georgian.cleaned(F.col("surface")).alias("form")), F.struct(F.lit(1).alias("tier"), georgian.scoped_norm(F.col("surface")).alias("form")), F.struct(F.lit(2).alias("tier"), georgian.cleaned(F.col("surface")).alias("form"))))
    tried = words.select("text_id", "surface").distinct().select("text_id", "surface", probe.alias("p")).select("text_id", "surface", "p.tier", "p.form")
    hits = tried.join(side, ["text_id", "tier", "form"])
    best = hits.groupBy("text_id", "surface").agg(F.min(F.struct("tier", "e")).alias("b"))
    return best.select("text_id", "surface", F.col("b.e.id").alias("id"), F.col("b.tier").alias("tier"))


def carried_over(words: DataFrame, matched: DataFrame, carry: DataFrame) -> DataFrame:
    """(text_id, surface, id): the corpus-wide map ``carry`` (surface, id) first, then the scoped match."""
    c = carry.select("surface", F.col("id").alias("__carried")).dropDuplicates(["surface"])
    m = matched.select("text_id", "surface", F.col("id").alias("__scoped"))
    out = words.select("text_id", "surface").distinct().join(c, "surface", "left").join(m, ["text_id", "surface"], "left")
    return out.select("text_id", "surface", F.coalesce("__carried", "__scoped").alias("id")).filter("id is not null")


def covered(ids: DataFrame, more: DataFrame) -> DataFrame:
    """(id): the distinct ids of both."""
    return ids.select("id").union(more.select("id")).distinct()
