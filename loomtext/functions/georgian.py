"""Column functions for Old Georgian words: script, spelling, case endings, stems, collation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: they decide which rows come out, so they are what they are. ---
#: Archaic letters and what they are folded to.
ARCHAIC, FOLDED = "ჳჲჱჴ", "ვიეხ"
#: Capitals (the older script) run parallel to the later letters, but for the last five.
CAPITALS = "".join(map(chr, range(0x10A0, 0x10C6)))
LETTERS = "".join(map(chr, range(0x10D0, 0x10F1))) + "ჯჰჴხჵ"
#: Characters of a word; the wider class adds later capitals and letters.
WORD = "[Ⴀ-Ⴥა-ჿⴀ-⴯]+"
WIDE_WORD = "[Ⴀ-ჿⴀ-⴯Ა-Ჿ]+"
#: The alphabet in its own order.
ALPHABET = "აბგდევზჱთიკლმნჲოპჟრსტჳუფქღყშჩცძწჭჴხჯჰჵ"
#: Case endings in the order they are tried, with the length cut off.
CASES = [("ის", 2, "genitive"), ("ს", 1, "dative"), ("ით", 2, "instrumental"), ("ად", 2, "adverbial"), ("ო", 1, "vocative"), ("ი", 1, "nominative")]
#: Suffixes by stem class.
PARADIGMS = {
    "consonant": ["ი", "მა", "მან", "სა", "ს", "ისა", "ის", "ითა", "ით", "ად", "ო", "ნი", "თა", "ჲ"],
    "vowel_a": ["სა", "ს", "ისა", "ის", "ჲ", "ათა", "ათ", "ად", "ნი", "ანი", "თა", "ო", "მა", "მან"],
    "vowel_e": ["ისა", "ის", "სა", "ს", "ითა", "ით", "ად", "ნი", "თა", "ო", "მა", "მან"],
    "vowel_o": ["სა", "ს", "ისა", "ის", "თა", "ად", "ნი"],
    "vowel_u": ["სა", "ს", "ისა", "ის", "ითა", "ით", "თა", "ნი", "ად"],
}
#: Endings after which a word still belongs to a name's, or an entry's, stem.
NAME_ENDINGS = ["ი", "ჲ", "ის", "ისა", "ისი", "ს", "სა", "თა", "ით", "ითა", "მან", "მა", "ე", "ესა", "ად", "ო", "ნი", "ნ", "სი", "გან", "ისგან", "მდე"]
ENTRY_ENDINGS = [
    "ი", "ჲ", "ის", "ისა", "ისი", "ს", "სა", "თა", "ითა", "ით", "მან", "მა", "ე", "ესა", "ეს", "ად", "ო", "ოჲ",
    "ნი", "ნ", "თ", "სი", "ებ", "ება", "ებს", "ებისა", "მდე", "გან", "ისგან",
]
#: Letters in identifiers.
ROMAN = {
    "ა": "a", "ბ": "b", "გ": "g", "დ": "d", "ე": "e", "ვ": "v", "ზ": "z", "თ": "t", "ი": "i", "კ": "k", "ლ": "l", "მ": "m", "ნ": "n",
    "ო": "o", "პ": "p", "ჟ": "zh", "რ": "r", "ს": "s", "ტ": "t", "უ": "u", "ფ": "f", "ქ": "q", "ღ": "gh", "ყ": "y", "შ": "sh", "ჩ": "ch",
    "ც": "ts", "ძ": "dz", "წ": "w", "ჭ": "j", "ხ": "x", "ჯ": "J", "ჰ": "h", "ჱ": "e", "ჲ": "i", "ჳ": "v", "ჴ": "x", "ჵ": "o", "ჶ": "f",
}
#: Letters in page names.
SLUGS = {
    "ა": "a", "ბ": "b", "გ": "g", "დ": "d", "ე": "e", "ვ": "v", "ზ": "z", "ჱ": "he", "თ": "t", "ი": "i", "კ": "k", "ლ": "l", "მ": "m",
    "ნ": "n", "ჲ": "ji", "ო": "o", "პ": "p", "ჟ": "zh", "რ": "r", "ს": "s", "ტ": "t2", "ჳ": "we", "უ": "u", "ფ": "f", "ქ": "q",
    "ღ": "gh", "ყ": "y", "შ": "sh", "ჩ": "ch", "ც": "ts", "ძ": "dz", "წ": "w", "ჭ": "chw", "ჴ": "kha", "ხ": "x", "ჯ": "j", "ჰ": "h", "ჵ": "hoe",
}
# --- End of fixed values. ---


def _map(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])


def _letters(word: Column) -> Column:
    return F.filter(F.split(word, ""), lambda c: c != "")


def normalise(word: Column) -> Column:
    """Archaic letters folded. The suffixes that end in one of them are folded too, so none is left to cut."""
    return F.translate(word, ARCHAIC, FOLDED)


def cleaned(word: Column) -> Column:
    """Without titlo, white space and hyphens."""
    return F.regexp_replace(F.coalesce(word, F.lit("")), r"(?U)[҃\s\-]", "")


def untitled(word: Column) -> Column:
    """Without titlo."""
    return F.replace(F.coalesce(word, F.lit("")), F.lit("҃"), F.lit(""))


def scoped_norm(word: Column) -> Column:
    """``cleaned`` with three of the archaic letters folded."""
    return F.translate(cleaned(word), "ჱჲჳ", "ეივ")


def later_script(word: Column) -> Column:
    """Capitals of the older script as later letters."""
    return F.translate(word, CAPITALS, LETTERS)


def initial_letter(text: Column) -> Column:
    """The later letter of an ornate initial, empty if it isn't a capital of the older script."""
    first = F.left(F.trim(F.coalesce(text, F.lit(""))), F.lit(1))
    return F.when(first.rlike("^[Ⴀ-Ⴥ]"), later_script(first)).otherwise("")


def strip_case(word: Column, cases: list[tuple[str, int, str]] = CASES) -> Column:
    """struct(stem, case) by the first case ending that fits."""
    out = F.struct(word.alias("stem"), F.lit("uninflected").alias("case"))
    for ending, cut, name in reversed(cases):
        kept = F.left(word, F.greatest(F.char_length(word) - cut, F.lit(0)))
        out = F.when(F.endswith(word, F.lit(ending)), F.struct(kept.alias("stem"), F.lit(name).alias("case"))).otherwise(out)
    return out


def cut_inflection(form: Column) -> Column:
    """What precedes the first hyphen, trimmed."""
    return F.trim(F.element_at(F.split(form, "-"), 1))


def roman_id(word: Column, prefix: str = "lex-", table: dict[str, str] = ROMAN) -> Column:
    """Identifier of a word by a letter table; letters without a counterpart drop out, nothing left gives an empty string."""
    known = _map(table)
    s = F.lower(F.array_join(F.transform(_letters(F.trim(word)), lambda c: F.coalesce(F.element_at(known, c), F.lit(""))), ""))
    return F.when(s == "", "").otherwise(F.concat(F.lit(prefix), s))


def dashed_id(raw: Column) -> Column:
    """``lex.a_b`` as ``lex-a-b``."""
    return F.regexp_replace(F.regexp_replace(F.trim(raw), r"^lex\.", "lex-"), r"[._]", "-")


def letter_slug(word: Column, default: str = "a") -> Column:
    """Page name of a word's first letter."""
    return F.coalesce(F.element_at(_map(SLUGS), F.left(word, F.lit(1))), F.lit(default))


def split_lemmas(raw: Column) -> Column:
    """Forms of a lemma cell separated by commas or semicolons."""
    return F.filter(F.transform(F.split(raw, r"[,;]\s*"), lambda x: F.trim(x)), lambda x: x != "")


def split_refs(raw: Column) -> Column:
    """Cross references of a cell separated by bars; none gives an empty array."""
    return F.filter(F.transform(F.split(F.coalesce(raw, F.lit("")), r"\|"), lambda x: F.trim(x)), lambda x: x != "")


def stem_class(lemma: Column, least: int = 3) -> Column:
    """struct(stem, class), null if the stem is shorter than ``least``."""
    cut = F.left(lemma, F.char_length(lemma) - 1)
    pick = lambda stem, name: F.when(F.char_length(stem) >= least, F.struct(stem.alias("stem"), F.lit(name).alias("class")))
    ends = lambda e: F.endswith(lemma, F.lit(e))
    return (
        F.when(ends("ი"), pick(cut, "consonant")).when(ends("ა"), pick(lemma, "vowel_a")).when(ends("ე"), pick(cut, "vowel_e"))
        .when(ends("ო"), pick(lemma, "vowel_o")).when(ends("უ"), pick(lemma, "vowel_u")).otherwise(pick(lemma, "consonant"))
    )


def stem_forms(base: Column, endings: list[str], least: int, vowels: str = "[იჲ]$") -> Column:
    """All cleaned words that belong to a base form: itself, its stem, and its stem with an ending; a base shorter
    than ``least`` only itself. Equal to testing a word for them, but joinable by equality."""
    long_enough = F.char_length(base) >= 4
    stem = F.when(long_enough & base.rlike(vowels), F.left(base, F.char_length(base) - 1)).otherwise(base)
    grown = F.when(F.char_length(stem) >= 3, F.transform(F.array(*map(F.lit, endings)), lambda e: F.concat(stem, e))).otherwise(F.array().cast("array<string>"))
    return F.when(F.char_length(base) < least, F.array(base)).otherwise(F.array_distinct(F.concat(F.array(base, stem), grown)))


def collation_key(word: Column, alphabet: str = ALPHABET, unknown: int = 999) -> Column:
    """Array of letter places; compares like the alphabet, letters outside it last."""
    table = F.create_map(*[x for i, c in enumerate(alphabet) for x in (F.lit(c), F.lit(i))])
    return F.transform(_letters(word), lambda c: F.coalesce(F.element_at(table, c), F.lit(unknown)))
