"""Growing and cleaning a lexicon: candidates, skeleton entries, provenance notes, repairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomtext.functions.strings import distinct_parts, html_escaped, labelled, primary_source


def eligible(matched: DataFrame, existing: DataFrame, tiers=("primary", "master")) -> DataFrame:
    """The rows of ``matched`` (tokens or types) that matched exactly an id that is no entry yet."""
    ok = F.col("match_tier").isin(*tiers) & (F.col("confidence") == "exact") & (F.col("in_lexicon") != "1") & (F.col("match_id") != "") & (F.char_length("match_lemma") >= 2)
    return matched.filter(ok).join(existing.select(F.col("xml_id").alias("match_id")).distinct(), "match_id", "left_anti")


def candidates(matched: DataFrame, existing: DataFrame, tiers=("primary", "master"), order: str = "token_id", n: str | None = None) -> DataFrame:
    """(match_id, lemma, def_ka, source, tier, freq, text_count) for ids that matched exactly and are no entry yet; what is
    said of an id comes from its first token in ``order``. Rows are tokens, or stand for ``n`` tokens each."""
    rows = eligible(matched, existing, tiers)
    first = F.min_by(F.struct(F.col("match_lemma").alias("lemma"), F.col("match_def_ka").alias("def_ka"), F.col("match_source").alias("source"), F.col("match_tier").alias("tier")), order)
    return rows.groupBy("match_id").agg(first.alias("x"), F.sum(F.col(n) if n else F.lit(1)).alias("freq"), F.count_distinct("text_id").alias("text_count")).select("match_id", "x.*", "freq", "text_count")


def corpus_only(existing: DataFrame, *dictionaries: DataFrame) -> DataFrame:
    """(xml_id): existing ids that no dictionary has."""
    out = existing.select("xml_id").distinct()
    for d in dictionaries:
        out = out.join(d.select("xml_id").distinct(), "xml_id", "left_anti")
    return out


def skeletons(found: DataFrame, labels: dict[str, str], doubtful: str = "master", note: str = "unverified") -> DataFrame:
    """(xml_id, source, label, lemma, def_ka, certainty, corpus, rank): the fields of a new entry, first dictionary's first, each by lemma."""
    src = primary_source(F.col("source"))
    return found.select(
        F.col("match_id").alias("xml_id"), src.alias("source"), labelled(src, labels).alias("label"), "lemma", F.left("def_ka", F.lit(200)).alias("def_ka"),
        F.when(F.col("tier") == doubtful, note).alias("certainty"), F.concat(F.lit("freq="), F.col("freq").cast("string"), F.lit("; texts="), F.col("text_count").cast("string")).alias("corpus"),
        F.struct((F.col("tier") == doubtful).alias("second"), "lemma").alias("rank"),
    )


def entry_markup(new: DataFrame) -> DataFrame:
    """(xml_id, rank, markup) of skeleton entries."""
    esc = lambda c: html_escaped(F.col(c))
    has = F.col("source") != ""
    parts = F.concat(
        F.lit('<entry xml:id="'), esc("xml_id"), F.lit('"'), F.when(has, F.concat(F.lit(' source="'), esc("source"), F.lit('"'))).otherwise(""), F.lit(">"),
        F.lit('<form type="lemma"><orth xml:lang="ka">'), esc("lemma"), F.lit("</orth></form><gramGrp><pos/></gramGrp>"),
        F.when(F.col("def_ka") != "", F.concat(F.lit('<sense n="1"><def xml:lang="ka">'), esc("def_ka"), F.lit("</def></sense>"))).otherwise(""),
        F.when(has, F.concat(F.lit('<xr type="source"><ref target="'), esc("source"), F.lit('">'), esc("label"), F.lit("</ref></xr>"))).otherwise(""),
        F.coalesce(F.concat(F.lit('<note type="certainty">'), esc("certainty"), F.lit("</note>")), F.lit("")),
        F.lit('<note type="corpus">'), esc("corpus"), F.lit("</note></entry>"),
    )
    return new.select("xml_id", "rank", parts.alias("markup"))


def appended(entries: DataFrame, new: DataFrame, corpus_ids: DataFrame, note: str) -> DataFrame:
    """``entries`` (xml_id, source, lemma, def_ka, sources array) with ``new`` ones, and ``note`` added as a source to those entries of
    ``corpus_ids`` that have none. Nothing new: the entries as they are, without notes."""
    if new.isEmpty():
        return entries
    mine = corpus_ids.select("xml_id").distinct().withColumn("__own", F.lit(True))
    noted = entries.join(mine, "xml_id", "left")
    add = F.coalesce("__own", F.lit(False)) & (F.size("sources") == 0)
    noted = noted.withColumn("sources", F.when(add, F.array(F.lit(note))).otherwise(F.col("sources"))).drop("__own")
    made = new.select("xml_id", "source", "lemma", "def_ka", F.array().cast("array<string>").alias("sources"))
    return noted.select("xml_id", "source", "lemma", "def_ka", "sources").unionByName(made)


def cleaned(entries: DataFrame, placeholder: str, renamed: dict[str, str]) -> DataFrame:
    """``entries`` (xml_id, pos, source, labels array) with placeholder parts of speech cleared, ids renamed, and repeated
    labels and sources taken out, in order."""
    return entries.select(
        labelled(F.col("xml_id"), renamed).alias("xml_id"),
        F.when(F.contains("pos", F.lit(placeholder)), None).otherwise(F.col("pos")).alias("pos"),
        distinct_parts(F.col("source"), "|", "|", trim=False).alias("source"),
        F.transform("labels", lambda x: F.when(F.contains(x, F.lit(";")), distinct_parts(x, ";", "; ")).otherwise(x)).alias("labels"),
    )


def renamed_ids(paragraphs: DataFrame, catalogue: DataFrame) -> DataFrame:
    """``paragraphs`` (root_id, file, para_id) under the ids that ``catalogue`` (xml_id, file) gives their files: the root, and
    paragraph ids that begin with the old root id and ``-`` or ``_``. Only files whose id differs change."""
    c = catalogue.select(F.col("file"), F.col("xml_id").alias("__new")).dropDuplicates(["file"])
    df = paragraphs.join(c, "file", "left").withColumn("__new", F.coalesce("__new", "root_id"))
    prefixed = F.startswith("para_id", F.concat("root_id", F.lit("-"))) | F.startswith("para_id", F.concat("root_id", F.lit("_")))
    tail = F.substring(F.col("para_id"), F.char_length("root_id") + 1, F.lit(1 << 30))
    para = F.when((F.col("__new") != F.col("root_id")) & prefixed, F.concat("__new", tail)).otherwise(F.col("para_id"))
    return df.select("file", F.col("__new").alias("root_id"), para.alias("para_id"), (F.col("__new") != F.col("root_id")).alias("changed"))
