"""Personal data replaced by keyed surrogates, as DataFrame expressions only.

Entities are found by pattern: e-mail addresses, IPv4 and IPv6 addresses, payment cards, account numbers
(IBAN), social security numbers, phone numbers, and names after a title. Each distinct entity gets
a surrogate drawn from a keyed SHA-256 of its kind and canonical form, so one entity has one
surrogate in the whole corpus (coreference) without a shared dictionary. A name's words are
replaced one by one and a word has one surrogate wherever it stands: "Mrs Anna Weber", a later "Dr Anna Weber",
"Mrs Weber's" and, in the same document, "Anna Weber" or "Weber" without a title agree. Addresses of one
mail domain keep one domain. Surrogates keep the kind, the punctuation, the script and, for given names, the
gender that titles show anywhere in the corpus (none if they contradict each other). Cards and account
numbers that pass their check digits get surrogates that pass too.

Distinctness is checked: of entities of one kind whose surrogates coincide, or whose surrogate is an
entity of the corpus, all but the smallest draw again with a longer form or another attempt.

Not every word after a title is a name. A title that can close a sentence ("I saw the Dr. The office was closed.") takes no
word that the corpus writes in small letters as often as with a capital, and no title takes an office ("Mr President"). Words of
names that are ordinary in that sense, months, weekdays and offices are replaced behind a title only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomtext.llm.staging import free_name, join_counted, stage

#: The titles that announce a name, by the gender they show.
TITLES = {
    "m": ["Mr", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "г-н", "господин", "κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mademoiselle", "Mlle", "Señora", "Sra", "Señorita", "г-жа", "госпожа", "κυρία"],
    "": ["Dr", "Prof"],
}
#: Syllables and endings that surrogate names are built from, by script.
SYLLABLES = {
    "latin": "ba be bi bo da de di do ka ke ki ko la le li lo ma me mi mo na ne ni no ra re ri ro sa se si so".split(),
    "cyrillic": "ба бе би бо да де ди до ка ке ки ко ла ле ли ло ма ме ми мо на не ни но ра ре ри ро са се си со".split(),
    "greek": "βα βε βι βο δα δε δι δο κα κε κι κο λα λε λι λο μα με μι μο να νε νι νο ρα ρε ρι ρο σα σε σι σο".split(),
}
ENDINGS = {
    "latin": {"m": "ron", "f": "lia", "": "ris", "s": "mer"},
    "cyrillic": {"m": "рон", "f": "лия", "": "рис", "s": "мер"},
    "greek": {"m": "ρων", "f": "λια", "": "ρις", "s": "μερ"},
}

#: Titles that stand without a name too, and so may close a sentence.
ALONE = ["Dr", "Prof", "Sr", "Sra"]
#: Offices, which a title can precede without a name; months and weekdays.
OFFICES = (
    "president chairman chairwoman chairperson chair speaker minister secretary mayor judge justice ambassador commissioner director professor doctor senator governor vice prime "
    "präsident präsidentin ministerin kanzler kanzlerin bürgermeister bürgermeisterin richter richterin direktor direktorin doktor professorin vorsitzender vorsitzende "
    "président présidente ministre maire juge ambassadeur directeur directrice docteur professeur presidente presidenta ministro ministra alcalde alcaldesa juez embajador directora doctora profesor profesora"
).split()
CALENDAR = (
    "january february march april may june july august september october november december monday tuesday wednesday thursday friday saturday sunday "
    "januar februar märz mai juni juli oktober dezember montag dienstag mittwoch donnerstag freitag samstag sonnabend sonntag "
    "janvier février mars avril juin juillet août septembre octobre novembre décembre lundi mardi mercredi jeudi vendredi samedi dimanche "
    "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre lunes martes miércoles jueves viernes sábado domingo"
).split()


def _by_first_letter(words: list[str]) -> str:
    """An alternation that is left at once where no word's first letter stands."""
    firsts = sorted({w[0] for w in words})
    tails = {f: sorted((w[1:].replace("-", "\\-") for w in words if w[0] == f), key=lambda t: (-len(t), t)) for f in firsts}
    return f"(?=[{''.join(firsts)}])(?:" + "|".join(f"{f}(?:{'|'.join(ts)})" for f, ts in tails.items()) + ")"


_titles = _by_first_letter([t for ts in TITLES.values() for t in ts])
#: Every entity begins where no letter or digit precedes; the patterns add what else must not.
START = r"(?<![\p{L}\p{N}])"
EMAIL = r"[\p{L}\p{N}](?:[\p{L}\p{N}._%+\-]{0,62}[\p{L}\p{N}_%+\-])?@(?:[\p{L}\p{N}](?:[\p{L}\p{N}\-]{0,61}[\p{L}\p{N}])?\.){1,8}\p{L}{2,24}(?![\p{L}\p{N}])"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IP = rf"(?<!\.)(?:{OCTET}\.){{3}}{OCTET}(?![\d]|\.\d)"
_hex = "[0-9A-Fa-f]{1,4}"
#: All eight groups, or a shortened form whose first group has a digit (so that no a::b of a program is one).
IP6 = rf"(?<!:)(?:(?:{_hex}:){{7}}{_hex}|(?=[A-Fa-f]{{0,3}}\d)[0-9A-Fa-f]{{3,4}}(?::{_hex}){{0,5}}::(?:{_hex}(?::{_hex}){{0,5}})?)(?![\p{{L}}\p{{N}}:])"
IBAN = r"[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"
SSN = r"(?<!-)\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}\-])"
CARD = r"(?<![\-.])(?:\d{4}[ \-]\d{4}[ \-]\d{4}[ \-]\d{1,7}|3\d{3}[ \-]\d{6}[ \-]\d{5}|[2-6]\d{12,18})(?![\p{L}\p{N}\-]|\.\d)"
#: A number with a country's code has seven digits at least.
SEVEN = r"(?=(?:[ .\-()]{0,2}\d){7})"
PHONE = (
    rf"(?:\+{SEVEN}\d{{1,3}}[ .\-]?(?:\(\d{{1,4}}\)[ .\-]?)?\d{{1,4}}(?:[ .\-]?\d{{2,4}}){{1,4}}"
    rf"|(?<!\d[.\-])(?:(?:1[ .\-]?)?\(\d{{3}}\)[ .\-]?\d{{3}}[ .\-]\d{{4}}|(?:1[ .\-])?\d{{3}}[.\-]\d{{3}}[.\-]\d{{4}}|1[ ]\d{{3}}[ ]\d{{3}}[ ]\d{{4}}"
    rf"|00{SEVEN}\d{{1,3}}[ .\-]\d{{1,4}}(?:[ .\-]?\d{{2,4}}){{1,4}}))(?![\p{{L}}\p{{N}}]|[.\-]\d)"
)
#: Words in small letters that names hold.
PARTICLES = "von vom van der den dem de del della degli di da do dos das du des la le las los lo zu zur zum ter ten te af av bin ibn ben al el y e und".split()
_particles = "(?:" + "|".join(sorted(PARTICLES, key=lambda p: (-len(p), p))) + ")"
#: Initials, also joined ones, or a word with a capital; the possessive repeats neither give back nor recurse.
_piece = r"(?:\p{Lu}\.(?:[\-]?\p{Lu}\.)*+(?!\p{L})|(?:[dl]['’]|(?:al|el)-)?\p{Lu}[\p{L}\p{M}'’\-]*+)"
NAME = rf"{_titles}\.?(?:[ ]{_titles}(?:\.|(?![\p{{L}}'’\-])))*+(?:[ ](?:{_particles}[ ])*+{_piece})++"
#: From this attempt on numbers and addresses grow as names and e-mail addresses do from the first, so that no form is ever full.
GROWS = 8
#: IPv4 addresses stay such for so many attempts, the later ones drawn from all addresses.
IP_GROWS = 64
#: In the order that decides an entity's kind.
KINDS = {"email": EMAIL, "ip": IP, "ip6": IP6, "iban": IBAN, "ssn": SSN, "card": CARD, "phone": PHONE, "name": NAME}
ANY = START + "(?:" + "|".join(f"(?:{p})" for p in KINDS.values()) + ")"
TITLED = rf"{_titles}\.?[ ][\p{{Lu}}\p{{Ll}}]"


def _may_hold(text: Column) -> Column:
    """Cheap tests that every text with an entity passes: a digit or an at sign, or a title; plain substrings come first."""
    words = sorted({t for ts in TITLES.values() for t in ts})
    words = [w for w in words if not any(w != o and o in w for o in words)]  # a longer title contains the shorter
    some = F.lit(False)
    for w in words:
        some = some | F.contains(text, F.lit(w))
    return text.rlike("[0-9@]") | (some & text.rlike(TITLED))


def _found(text: Column) -> Column:
    return F.when(_may_hold(text), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>"))


def _place() -> list[Column]:
    """What a text's entities are gathered by: the row's id and two hashes of its text, so that rows without an id, or of one id, stay apart."""
    return [F.col("doc_id").alias("id"), F.xxhash64("text").alias("t"), F.xxhash64(F.lit(1), F.col("text")).alias("t2")]


def entities(docs: DataFrame) -> DataFrame:
    """(id, t, t2, entity): the distinct entities of each row's text."""
    return docs.select(*_place(), F.explode(F.array_distinct(_found(F.col("text")))).alias("entity"))


def _kind(entity: Column) -> Column:
    kind = F.lit("name")
    for k, p in reversed(KINDS.items()):
        kind = F.when(entity.rlike(f"^(?:{p})$"), k).otherwise(kind)
    return kind


#: Words as names have them, without a possessive; what stands between them.
WORD = r"[\p{L}\p{M}]+(?:[\-'’](?![sS](?![\p{L}\p{M}]))[\p{L}\p{M}]+)*"
#: What may stand before a word, of several the last; a word with it, white space or punctuation behind it. What ends a sentence or a line comes first.
LEADS = " \t\n\r\f\v().!?:…\"'«»„“”"
SPOT = rf"(?:^|[.!?:…\n\r][)\"'»”\s]*+|[\s(«„“\"'])(?:{WORD})(?=[\s.,;:!?)\"'’»”…]|$)"
#: What follows a name's word: a possessive, which stays.
POSSESSIVE = "(['’][sS]?)$"


_title = rf"{_titles}(?:\.|(?![\p{{L}}'’\-]))"


def numbered_entities(found: DataFrame) -> DataFrame:
    """(e, entity, n, kind, first, closing) for the distinct entities of ``found`` (entity): a number, how many texts have it, its kind; of a
    name the first word after its titles, in small letters, and whether it follows a title that may close a sentence."""
    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = found.groupBy("entity").agg(F.count("*").alias("n")).repartition(n, "entity")  # by number: telling the kind is costly
    name = F.col("kind") == "name"
    first = F.regexp_extract("entity", rf"^(?:{_title}[ ])+(?:{_particles}[ ])*([^ ]+)", 1)
    first = F.lower(F.regexp_replace(F.regexp_replace(first, POSSESSIVE, ""), r"\.$", ""))
    closing = F.col("entity").rlike(rf"^(?:{_title}[ ])*(?:{'|'.join(ALONE)})\.[ ](?=\p{{Lu}})(?!{_title})")
    counted = counted.withColumn("kind", _kind(F.col("entity")))
    return counted.select(F.monotonically_increasing_id().alias("e"), "entity", "n", "kind", F.when(name, first).alias("first"), (name & closing).alias("closing"))


def ordinary_words(docs: DataFrame, words: DataFrame) -> DataFrame:
    """(canon): those of ``words`` (canon, distinct) that at least as many rows of ``docs`` (text) write in small letters as with a capital
    inside a sentence.

    All texts are read; a word beside an at sign, a dot or the like is none. A bitmap of 2^20 hashes keeps other words from being counted; it never
    drops one that is asked for.
    """
    cell = lambda w: F.pmod(F.xxhash64(w), F.lit(1 << 20)).cast("int")
    spark = docs.sparkSession
    cells = words.select(cell(F.col("canon")).alias("c")).groupBy(F.shiftright("c", 5).alias("id")).agg(F.expr("bit_or(shiftleft(1, c % 32))").alias("bits"))
    row = F.array_sort(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0)).alias("bits"))))["bits"]  # 32,768 numbers
    asked = spark.range(1 << 15).select(F.col("id").cast("int").alias("id")).join(cells, "id", "left").agg(row.alias("asked"))

    def wanted(w: Column) -> Column:
        c = cell(F.lower(w))
        return F.getbit(F.get("asked", F.shiftright(c, 5)), c % 32) == 1

    some = docs.select("text").crossJoin(F.broadcast(asked))  # one row beside each text
    bare = lambda x: F.ltrim(x, F.lit(LEADS))
    some = some.select(F.filter(F.regexp_extract_all("text", F.lit(SPOT), F.lit(0)), lambda x: wanted(bare(x))).alias("xs"))

    def spelling(x: Column) -> Column:
        """s or c before the word in small letters; nothing where a sentence's begin tells nothing."""
        word = bare(x)
        begins = (x == word) | x.rlike(r"^[.!?:…\n\r]")
        return F.when(word == F.lower(word), F.concat(F.lit("s"), word)).when(~begins, F.concat(F.lit("c"), F.lower(word)))

    forms = some.select(F.explode(F.array_distinct(F.array_compact(F.transform("xs", spelling)))).alias("f"))
    forms = forms.select(F.substring("f", 2, 1 << 30).alias("canon"), (F.left("f", F.lit(1)) == "s").alias("small"))
    counted = forms.groupBy("canon").agg(F.count_if("small").alias("small"), F.count_if(~F.col("small")).alias("capital"))
    return counted.filter("small > 0 and small >= capital").join(words.hint("merge"), "canon", "left_semi").select("canon")


def not_names(entities_: DataFrame, ordinary: DataFrame) -> DataFrame:
    """(e): the numbers of entities found as names that are none."""
    office = F.col("first").isin(OFFICES)
    closing = entities_.filter("closing").join(ordinary.select(F.col("canon").alias("first")).hint("merge"), "first", "left_semi")
    return entities_.filter(office).select("e").unionByName(closing.select("e")).distinct()


def parts(distinct: DataFrame) -> DataFrame:
    """(e, n, kind, at, part, tail, canon, script, given, gender): an entity's parts to replace, from (e, entity, n, kind).

    Names have one for each word after the title, e-mail addresses two: the local part and the domain. canon is
    what decides identity: digits for numbers, lower case for addresses and names. tail stays as it is. No part carries the whole
    entity but an address', which is short.
    """
    words = F.expr("case kind when 'name' then split(entity, ' ') when 'email' then split(entity, '@') else array(entity) end")
    title = F.regexp_replace(F.substring_index("entity", " ", 1), r"\.$", "")
    gender = F.when(title.isin(TITLES["m"]), "m").when(title.isin(TITLES["f"]), "f").otherwise("")
    df = distinct.select("e", "n", "kind", gender.alias("gender"), F.when(F.col("kind") == "email", F.lower("entity")).alias("address"), words.alias("words"))
    df = df.select("e", "n", "kind", "gender", "address", (F.size("words") - 1).alias("last"), F.posexplode("words").alias("at", "part"))
    last = F.col("last")
    # a further title ("Frau Prof. Dr. Weber") stays, unless it is the last word
    also = F.col("part").rlike(rf"^{_titles}\.?$") & (F.col("at") < last)
    kind = F.when((F.col("kind") == "email") & (F.col("at") == 1), "domain").when(F.col("kind") != "name", F.col("kind"))
    kind = kind.when((F.col("at") == 0) | F.col("part").isin(PARTICLES) | also, "title").otherwise("name")
    df = df.select("e", "n", kind.alias("kind"), "at", "part", "gender", (F.col("at") < last).alias("given"), "address")
    name = F.col("kind") == "name"
    tail = F.when(name, F.regexp_extract("part", POSSESSIVE, 1)).otherwise("")
    bare = F.when(name, F.regexp_replace(F.regexp_replace("part", POSSESSIVE, ""), r"\.$", "")).otherwise(F.col("part"))  # an initial without its dot
    digits = F.regexp_replace("part", r"\D", "")
    country = F.regexp_extract("part", r"^\+(\d{1,3})", 1)  # stays as it is
    phone = F.concat(country, F.lit(" "), F.substring(digits, F.length(country) + 1, F.length(digits)))
    plain = F.when(F.col("kind") == "email", F.col("address")).otherwise(F.lower(F.regexp_replace(bare, " ", "")))
    canon = F.when(F.col("kind") == "phone", phone).when(F.col("kind").isin("card", "ssn"), digits).otherwise(plain)
    script = F.when(F.col("part").rlike(r"\p{IsCyrillic}"), "cyrillic").when(F.col("part").rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
    return df.select("e", "n", "kind", "at", bare.alias("part"), tail.alias("tail"), canon.alias("canon"), script.alias("script"), "given", "gender")


def identities(pieces: DataFrame) -> DataFrame:
    """(kind, canon, script, role): what gets a surrogate of its own. A word that any name has before its last is a given
    name; its role is the gender that titles show, none where they differ; other words of names are surnames ("s")."""
    shown = lambda g: F.max(F.col("given") & (F.col("gender") == g))
    one = pieces.filter("kind <> 'title'").groupBy("kind", "canon").agg(F.min("script").alias("script"), F.max("given").alias("given"), shown("m").alias("m"), shown("f").alias("f"))
    role = F.when(F.col("kind") != "name", "").when(~F.col("given"), "s").when(F.col("m") & ~F.col("f"), "m").when(F.col("f") & ~F.col("m"), "f").otherwise("")
    return one.select("kind", "canon", "script", role.alias("role"))


def proposals(keys: DataFrame, key: str) -> DataFrame:
    """``keys`` (kind, canon, script, role, attempt) with ``made``: the surrogate of the canonical form."""
    msg = [F.concat_ws("\u0001", F.lit(key), "kind", "canon", F.col("attempt").cast("string"), F.lit(i)) for i in "ab"]
    # dealt out by number: the forms below are the costly part, and the exchange keeps the digests from being made for each use
    n = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df = keys.withColumn("hx", F.concat(*[F.sha2(m, 256) for m in msg])).repartition(n, "kind", "canon")
    shape = F.expr(f"concat(canon, repeat('0', greatest(attempt - {GROWS - 1}, 0)))")  # what the numbers are drawn in the shape of
    numbers = F.expr("transform(sequence(0, 63), i -> cast(conv(substr(hx, 2 * i + 1, 2), 16, 10) as int))")
    df = df.withColumn("shape", shape).withColumn("z", numbers)
    digits = "array_join(transform(split(shape, ''), (c, i) -> if(i = 0 and c <> '0', cast(1 + z[0] % 9 as string), cast(z[i % 64] % 10 as string))), '')"
    phone = digits.replace("shape", "substring_index(shape, ' ', -1)")
    phone = f"concat(substring_index(canon, ' ', 1), ' ', {phone})"
    # the leading digits that tell the issuer's or the country's kind stay
    card = "concat(substr(canon, 1, 1), array_join(transform(split(substr(shape, 2), ''), (c, i) -> cast(z[i % 64] % 10 as string)), ''))"
    iban = "concat(upper(substr(canon, 1, 2)), '00', array_join(transform(split(upper(substr(shape, 5)), ''), (c, i) -> if(c rlike '[0-9]', cast(z[i % 64] % 10 as string), chr(65 + z[i % 64] % 26))), ''))"
    # IPv6 addresses of the range kept for documentation; IPv4 ones of one that isn't in use, then of all, and only when that is full IPv6 ones
    ip6 = "concat('2001:db8', array_join(transform(sequence(0, 5), i -> concat(':', lower(substr(hx, 4 * i + 1, 4)))), ''))"
    ip = f"case when attempt < {GROWS} then concat_ws('.', 240 + z[0] % 15, z[1], z[2], z[3]) when attempt < {IP_GROWS} then concat_ws('.', z[0], z[1], z[2], z[3]) else {ip6} end"
    local = "array_join(transform(split(substring_index(canon, '@', 1), ''), (c, i) -> case when c rlike '[0-9]' then cast(z[i % 64] % 10 as string) when c rlike '\\\\p{L}' then chr(97 + z[i % 64] % 26) else c end), '')"
    # told apart inside a domain only; the domain gets its own surrogate
    email = f"concat({local}, if(attempt > 0, lower(substr(hx, 90, 2 * attempt)), ''), '@', substring_index(canon, '@', -1))"
    domain = "concat(lower(substr(hx, 70, 10 + 2 * attempt)), '.example')"
    name = F.lit(None).cast("string")
    for script, syllables in SYLLABLES.items():
        table = "array(" + ", ".join(f"'{s}'" for s in syllables) + ")"
        tail = " ".join(f"when role = '{k}' then '{v}'" for k, v in ENDINGS[script].items())
        built = F.expr(f"concat(array_join(transform(sequence(0, 2 + attempt), i -> {table}[z[i % 64] % {len(syllables)}]), ''), case {tail} end)")
        name = F.when(F.col("script") == script, built).otherwise(name)
    forms = {"email": email, "domain": domain, "ip": ip, "ip6": ip6, "iban": iban, "card": card, "phone": phone, "ssn": digits}
    made = name
    for kind, form in forms.items():
        made = F.when(F.col("kind") == kind, F.expr(form)).otherwise(made)
    df = df.withColumn("made", made).drop("hx", "z", "shape")
    luhn = "aggregate(transform(reverse(split({0}, '')), (c, i) -> if(i % 2 = {1}, cast(c as int), 2 * cast(c as int) - if(cast(c as int) > 4, 9, 0))), 0, (a, x) -> a + x) % 10"
    valid = luhn.format("canon", 0) + " = 0"
    fixed = "concat(substr(made, 1, length(made) - 1), cast((10 - " + luhn.format("substr(made, 1, length(made) - 1)", 1) + ") % 10 as string))"
    value = "array_join(transform(split(concat(substr({0}, 5), substr({0}, 1, 4)), ''), c -> if(c rlike '[0-9]', c, cast(ascii(c) - 55 as string))), '')"
    mod97 = "aggregate(split(" + value + ", ''), 0, (a, c) -> (a * 10 + cast(c as int)) % 97)"
    iban_ok = mod97.format("upper(canon)") + " = 1"
    iban_fixed = "concat(substr(made, 1, 2), lpad(cast(98 - " + mod97.format("made") + " as string), 2, '0'), substr(made, 5))"
    return df.withColumn(
        "made",
        F.expr(f"case when kind = 'card' and {valid} then {fixed} when kind = 'iban' and {iban_ok} then lower({iban_fixed}) when kind = 'iban' then lower(made) else made end"),
    )


def assign(keys: DataFrame, key: str) -> DataFrame:
    """(kind, canon, made): surrogates for the distinct ``keys`` (kind, canon, script[, role]), no two of a kind the same
    and none an entity of the same kind. Forms grow with the attempts, so rounds go on until all are settled."""
    keys = stage(keys if "role" in keys.columns else keys.withColumn("role", F.lit("")), "surrogate-keys")
    taken = keys.select("kind", F.col("canon").alias("made")).distinct()
    open_, settled = keys.withColumn("attempt", F.lit(0)), None
    while True:
        tried = stage(proposals(open_, key), "surrogate-proposals")  # else the joins' null filters make them anew below the exchange
        first = tried.groupBy("kind", "made").agg(F.min("canon").alias("first"))
        barred = taken if settled is None else taken.unionByName(settled.select("kind", "made"))
        free = first.join(barred.hint("merge"), ["kind", "made"], "left_anti").withColumn("free", F.lit(True))
        tried = tried.join(free.hint("merge"), ["kind", "made"], "left").withColumn("won", F.expr("coalesce(free, false) and first = canon"))
        tried = stage(tried, "surrogate-round")
        won = tried.filter("won").select("kind", "canon", "made")
        settled = won if settled is None else settled.unionByName(won)
        lost = tried.filter("not won")
        if lost.isEmpty():
            return settled
        open_ = lost.select("kind", "canon", "script", "role", (F.col("attempt") + 1).alias("attempt"))


def _dressed() -> Column:
    """The surrogate in the part's own dress: its punctuation for numbers, its case for words."""
    # digits of the surrogate fill the digit places one after another; what a grown surrogate has more follows
    fill = "array_join(transform(split(part, ''), (c, i) -> if(c rlike '[0-9]', substr(replace(made, ' ', ''), length(regexp_replace(left(part, i + 1), '[^0-9]', '')), 1), c)), '')"
    spread = "array_join(transform(split(part, ''), (c, i) -> if(c = ' ', c, substr(upper(made), length(replace(left(part, i + 1), ' ', '')), 1))), '')"
    cased = "case when part = upper(part) and part <> lower(part) and (kind <> 'name' or length(replace(part, '.', '')) > 1) then upper(made) when left(part, 1) <> lower(left(part, 1)) then concat(upper(left(made, 1)), substr(made, 2)) else made end"
    more = "substr(replace(made, ' ', ''), length(regexp_replace(part, '{0}', '')) + 1)"
    fill, spread = f"concat({fill}, {more.format('[^0-9]')})", f"concat({spread}, upper({more.format(' ')}))"
    local = cased.replace("made", "substring_index(made, '@', 1)")
    return F.expr(
        f"case when kind = 'title' then part when kind in ('card', 'phone', 'ssn') then {fill} when kind = 'iban' then {spread} when kind in ('ip', 'ip6') then made when kind = 'email' then {local} else {cased} end"
    )


def surrogate_table(found: DataFrame, key: str, docs: DataFrame) -> DataFrame:
    """(entity, n, kind, surrogate, words) for the distinct entities of ``found`` (entity) that are none but seem so left out; words are the
    pairs (word, its surrogate) of a name's words of three letters or more that aren't ordinary words of ``docs``."""
    every = stage(numbered_entities(found), "entities")
    pieces = stage(parts(every), "entity-parts")
    names = pieces.filter("kind = 'name'").select("canon").unionByName(every.filter("first IS NOT NULL").select(F.col("first").alias("canon"))).distinct()
    names = stage(names, "name-words")
    ordinary = names.limit(0) if names.isEmpty() else stage(ordinary_words(docs, names), "ordinary-words")
    none = stage(not_names(every, ordinary), "not-names")
    every, pieces = (x.join(none.hint("merge"), "e", "left_anti") for x in (every, pieces))
    pieces = stage(pieces.join(ordinary.withColumn("ordinary", F.lit(True)).hint("merge"), "canon", "left"), "name-parts")
    # merge joins at every size: nothing that grows with the corpus is broadcast
    named = pieces.join(assign(identities(pieces), key).hint("merge"), ["kind", "canon"], "left").withColumn("new", _dressed())
    apart = (F.col("kind") == "name") & (F.char_length("part") > 2) & F.col("ordinary").isNull() & ~F.col("canon").isin(OFFICES + CALENDAR)
    named = named.withColumn("pair", F.when(apart, F.struct(F.col("part").alias("word"), F.col("new").alias("to")))).withColumn("new", F.concat("new", "tail"))
    whole = F.array_sort(F.collect_list(F.struct("at", "new", "kind", "pair")))  # a name's own words
    made = named.groupBy("e").agg(whole.alias("x"))
    table = every.select("e", "entity", "n", "kind").join(made.hint("merge"), "e")
    return table.select("entity", "n", "kind", F.expr("array_join(x.new, if(kind = 'email', '@', ' '))").alias("surrogate"), F.array_compact(F.col("x.pair")).alias("words"))


def pseudonymise(docs: DataFrame, key: str = "loomtext") -> DataFrame:
    """``docs`` with every entity of text replaced, and ``pii_entities`` (long), the number found by pattern.

    In a text with a titled name, that name's words (of three letters or more, spelt the same, and no ordinary words, months,
    weekdays or offices) are replaced where they stand without a title too. What seems a name behind a title but is none stays and doesn't count. All other columns stay as they are (a column pii_entities is
    overwritten; names that are used inside are chosen free of clashes). Texts without an
    entity, null and empty ones among them, stay exactly as they are with 0; long texts are read whole. Repeated rows are treated alike;
    ids may be null or repeat. The same key gives the same surrogates except where a collision is
    settled, which depends on the entities present. An empty table gives an empty one.
    """
    found = stage(entities(docs), "entity-mentions")
    names = docs.columns
    docs = docs.drop("pii_entities")
    if found.isEmpty():
        return docs.withColumn("pii_entities", F.lit(0).cast("long"))
    table = stage(surrogate_table(found, key, docs), "surrogates")
    id_, t_, t2_, map_, words_, found_, between_ = (free_name(n, names) for n in ("__id", "__t", "__t2", "__map", "__words", "__found", "__between"))
    maps = join_counted(found, table, "entity", "n").groupBy(F.col("id").alias(id_), F.col("t").alias(t_), F.col("t2").alias(t2_)).agg(
        F.map_from_entries(F.collect_set(F.struct("entity", "surrogate"))).alias(map_),
        F.map_from_entries(F.array_distinct(F.flatten(F.collect_list("words")))).alias(words_),
    )  # bounded by one text's own entities
    has = F.coalesce(_may_hold(F.col("text")) & F.col("text").rlike(ANY), F.lit(False))
    clean = docs.filter(~has).withColumn("pii_entities", F.lit(0).cast("long"))
    place = [c.eqNullSafe(F.col(n)) for c, n in zip([F.col("doc_id"), F.xxhash64("text"), F.xxhash64(F.lit(1), F.col("text"))], (id_, t_, t2_), strict=True)]
    dirty = docs.filter(has).join(maps.hint("merge"), place[0] & place[1] & place[2], "left")  # none where all that was found are no entities
    dirty = dirty.withColumn(found_, _found(F.col("text"))).withColumn(map_, F.coalesce(map_, F.create_map().cast("map<string,string>"))).withColumn(words_, F.coalesce(words_, F.create_map().cast("map<string,string>")))
    dirty = dirty.withColumn(between_, F.split("text", ANY, -1)).withColumn("pii_entities", F.size(F.filter(found_, lambda m: F.col(map_)[m].isNotNull())).cast("long"))
    rest = F.transform(between_, lambda s: F.when(F.size(words_) == 0, s).otherwise(F.array_join(F.transform(F.regexp_extract_all(s, F.lit(rf"{WORD}|(?s:[^\p{{L}}\p{{M}}]+|.)"), F.lit(0)), lambda w: F.coalesce(F.col(words_)[w], w)), "")))
    dirty = dirty.withColumn("text", F.array_join(F.zip_with(rest, found_, lambda s, m: F.concat(s, F.coalesce(F.col(map_)[m], m, F.lit("")))), ""))
    dirty = dirty.drop(id_, t_, t2_, map_, words_, found_, between_)
    return clean.unionByName(dirty).select(*[F.col(f"`{c}`") for c in names if c != "pii_entities"], "pii_entities")
