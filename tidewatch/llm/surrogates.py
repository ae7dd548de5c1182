"""Personal data replaced by keyed, type-consistent surrogates.

Emails, IPv4 addresses, phone numbers, card numbers, secrets and titled person names, of any number of words with initials
and particles, are found by one pattern. An
entity's surrogate comes from a keyed digest of its type and normal form, so every mention of it, in whatever spelling
or punctuation, gets the same one (coreference), rendered in the mention's own format: case, script, digit groups. A name's
gender is the entity's, told by the titles of all its mentions. Collision checks over the whole corpus keep it distinct: where two entities would get one surrogate, or a
surrogate is itself an entity of the corpus, the later one is rendered from its next digest until none is left.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatch.session import stored

#: where a session names the key that the registered query uses
KEY_CONF = "spark.tidewatch.surrogates.key"
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία")
MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος")
EITHER = ("Dr", "Prof")
_TITLES = "|".join(sorted(FEMALE + MALE + EITHER, key=lambda t: (-len(t), t)))
_PARTICLES = (
    "von", "van", "de", "da", "di", "del", "della", "der", "den", "dem", "do", "dos", "das", "du", "la", "las", "los", "le", "zu",
    "zum", "zur", "ter", "ten", "bin", "ibn", "al", "af", "av",
)
_NAME_WORD, _INITIAL, _PARTICLE = r"\p{Lu}[\p{L}\p{M}'’-]+", r"(?:\p{Lu}\.)++", f"(?:{'|'.join(_PARTICLES)})"
#: Starts where a run of address characters starts, or where the entity before ended: a long run without an @ is read once.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_SECRET_KEY = "(?i:password|passwd|secret|token|api_key|apikey) ?[=:]"
SECRET = rf"AKIA[0-9A-Z]{{16}}|(?<={_SECRET_KEY} ?\"?)[A-Za-z0-9_+/=-]{{8,}}|(?<![0-9A-Za-z])[0-9a-f]{{32,}}(?![0-9A-Za-z])"
IPV4 = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
CARD = r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])"
PHONE = r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,3}(?![0-9])|(?<![0-9])(?:\([0-9]{3}\) ?|[0-9]{3}-)[0-9]{3}-[0-9]{4}(?![0-9])"
_TITLED = rf"(?:(?:{_TITLES})\.? )+"
#: Titles, then any number of capitalised words, initials and particles before them, a capitalised word among them. Possessive,
#: so that names of any length take no stack.
NAME = rf"(?<!\p{{L}}){_TITLED}(?:(?:{_PARTICLE}|{_INITIAL}) )*+{_NAME_WORD}(?: (?:{_PARTICLE} )*+(?:{_INITIAL}|{_NAME_WORD}))*+"
#: In this order at each place.
ENTITY = "|".join(f"(?:{p})" for p in (EMAIL, SECRET, IPV4, CARD, PHONE, NAME))
#: A text without a match of this has no entity: numbers need a digit, mails an @, names a title, and secrets of letters only a
#: key before them, AKIA or a run of hex letters.
HINT = rf"[0-9@]|[=:](?<={_SECRET_KEY})|AKIA|[a-f]{{32}}|(?<!\p{{L}})(?:{_TITLES})\.? \p{{L}}"
#: From this attempt on, and at every multiple of it, surrogates are longer, so that those of a type are never used up.
_LONGER_FROM = 4
#: The country code after a +, by its digits alone, whatever stands between them: no code is the start of another.
COUNTRY = r"^\+(?:[17]|" + "|".join(
    f"{a}[^0-9]*[{b}]" for a, b in ((2, "07"), (3, "0-469"), (4, "013-9"), (5, "1-8"), (6, "0-6"), (8, "1246"), (9, "0-58"))
) + r"|[0-9](?:[^0-9]*[0-9]){2})"

_VOWELS = {"latin": "aeiou", "cyrillic": "аеиоу", "greek": "αειοω"}
_CONSONANTS = {"latin": "bdfglmnrstv", "cyrillic": "бдглмнрств", "greek": "βδγλμνρστ"}
_ENDINGS = {"latin": ("a", "on", "el"), "cyrillic": ("ова", "ов", "енко"), "greek": ("α", "ος", "η")}


def entity_type(mention: Column) -> Column:
    full = lambda p: F.concat(F.lit("^(?:"), F.lit(p), F.lit(r")$"))
    return (
        F.when(F.contains(mention, F.lit("@")), "email")
        .when(F.rlike(mention, full(r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}")), "ipv4")
        .when(F.rlike(mention, full(r"[0-9](?:[ -]?[0-9]){12,18}")), "card")
        .when(F.rlike(mention, full(r"[+(]?[0-9][0-9 ().-]+")), "phone")
        .when(F.contains(mention, F.lit(" ")), "name")
        .otherwise("secret")
    )


def normal_form(kind: Column, mention: Column) -> Column:
    """What all spellings of an entity have in common: digits of numbers (with a phone's +), lowered mails and names without title."""
    bare = F.regexp_replace(mention, f"^{_TITLED}", "")
    return (
        F.when(kind == "card", F.regexp_replace(mention, "[^0-9]", ""))
        .when(kind == "phone", F.regexp_replace(mention, "[^0-9+]", ""))
        .when(kind == "email", F.lower(mention))
        .when(kind == "name", F.lower(bare))
        .otherwise(mention)
    )


def _gender(kind: Column, mention: Column) -> Column:
    """0 female, 1 male, 2 not told by the title, or no name."""
    titles = F.regexp_extract(mention, f"^{_TITLED}", 0)
    has = lambda words: titles.rlike(rf"(?<!\p{{L}})(?:{'|'.join(words)})(?!\p{{L}})")
    return F.when(kind != "name", 2).when(has(FEMALE), 0).when(has(MALE), 1).otherwise(2)


def _script(text: Column) -> Column:
    return F.when(text.rlike(r"\p{IsCyrillic}"), "cyrillic").when(text.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _number(digest: Column, i: Column, modulus: int) -> Column:
    """A number below ``modulus`` from the i-th pair of digits of a digest of 64, round and round."""
    pair = F.substr(digest, (i * 2) % 64 + 1, F.lit(2))
    return (F.conv(pair, 16, 10).cast("int") % modulus).cast("int")


def _pick(letters: str, at: Column) -> Column:
    return F.substr(F.lit(letters), at + 1, F.lit(1))


def _shaped(text: Column, digest: Column, keep: str = "") -> Column:
    """Letters for letters of the same case and digits for digits, by their place among letters and digits; all else,
    and what a leading match of ``keep`` covers, stays."""
    head = F.regexp_extract(text, keep, 0) if keep else F.lit("")
    tail = F.substr(text, F.char_length(head) + 1)
    sign = r"[\p{L}0-9]"

    def one(c, i):
        letter = _pick("abcdefghijklmnopqrstuvwxyz", _number(digest, i, 26))
        return F.when(c.rlike("[0-9]"), _number(digest, i, 10).cast("string")).when(c.rlike(r"\p{Lu}"), F.upper(letter)).otherwise(letter)

    # what stands between the signs, and a new sign after each but the last
    made = F.transform(F.regexp_extract_all(tail, F.lit(sign), F.lit(0)), one)
    filled = F.zip_with(F.split(tail, sign, -1), made, lambda p, s: F.concat(p, F.coalesce(s, F.lit(""))))
    return F.concat(head, F.array_join(filled, ""))


def _longer(made: Column, digest: Column, attempt: Column, letters: str) -> Column:
    """Late attempts have one of ``letters`` more for each ``_LONGER_FROM`` attempts."""
    n = F.floor(attempt / _LONGER_FROM).cast("int")
    extra = F.transform(F.sequence(F.lit(1), n), lambda j: _pick(letters, _number(digest, 31 - j % 16, len(letters))))
    return F.when(n > 0, F.concat(made, F.array_join(extra, ""))).otherwise(made)


def _name(mention: Column, digest: Column, gender: Column, attempt: Column) -> Column:
    """A name in the mention's script with an ending of the gender, as many words and the same case, after its titles; initials for
    initials, particles for particles. Late attempts have more syllables, so that short names are not used up."""
    title = F.regexp_extract(mention, f"^{_TITLED}", 0)
    bare = F.substr(mention, F.char_length(title) + 1)
    # bound once: found anew for each word, a name of many words would take the square of its length
    once = F.struct(_script(bare).alias("script"), F.split(bare, " ").alias("parts"), digest.alias("digest"), gender.alias("gender"), attempt.alias("attempt"))
    made = F.transform(F.array(once), lambda e: _words(e["parts"], e["script"], e["digest"], e["gender"], e["attempt"]))
    return F.concat(title, F.get(made, F.lit(0)))


def _words(parts: Column, script: Column, digest: Column, gender: Column, attempt: Column) -> Column:
    """The words of a name replaced one by one."""

    def initials(w, k):
        letter = lambda s, i: F.upper(_pick(_CONSONANTS[s], _number(digest, k * 8 + i, len(_CONSONANTS[s]))))
        of = lambda i: F.when(script == "cyrillic", letter("cyrillic", i)).when(script == "greek", letter("greek", i)).otherwise(letter("latin", i))
        return F.array_join(F.transform(F.filter(F.split(w, ""), lambda c: c != ""), lambda c, i: F.when(c == ".", c).otherwise(of(i))), "")

    def word(w, k):
        made = None
        for s in ("latin", "cyrillic", "greek"):
            syllable = lambda j, s=s: F.concat(
                _pick(_CONSONANTS[s], _number(digest, k * 8 + 2 * j, len(_CONSONANTS[s]))), _pick(_VOWELS[s], _number(digest, k * 8 + 2 * j + 1, len(_VOWELS[s])))
            )
            ending = F.when(gender == 0, _ENDINGS[s][0]).when(gender == 1, _ENDINGS[s][1]).otherwise(_ENDINGS[s][2])
            late = F.floor(attempt / _LONGER_FROM).cast("int")
            more = F.when(late > 0, F.array_join(F.transform(F.sequence(F.lit(1), late), lambda j: syllable(j + 2)), "")).otherwise("")
            text = F.concat(syllable(0), syllable(1), syllable(2), more, ending)
            made = F.when(script == s, text) if made is None else made.when(script == s, text)
        # a particle in whatever case, as spellings differ in it; the last word is a name
        particle = F.lower(w).isin(*_PARTICLES) & (k < F.size(parts) - 1)
        made = F.when(particle, F.get(F.array(*map(F.lit, _PARTICLES)), _number(digest, k * 8, len(_PARTICLES)))).otherwise(made)
        capital = F.concat(F.upper(F.substr(made, F.lit(1), F.lit(1))), F.substr(made, F.lit(2)))
        cased = F.when(F.upper(w) == w, F.upper(made)).when(F.lower(w) == w, made).otherwise(capital)
        return F.when(F.contains(w, F.lit(".")), initials(w, k)).otherwise(cased)

    return F.array_join(F.transform(parts, word), " ")


def query_key(spark: SparkSession) -> str:
    """The session's key. Where none is set, one for the test tables, whose entities are made up: real data need a secret one."""
    return spark.conf.get(KEY_CONF, None) or "made-up tables only"


def entity_digest(kind: Column, mention: Column, attempt: Column, key: str) -> Column:
    """HMAC with SHA-256 of the entity and the attempt, as hex: without the key no entity can be tried out."""
    secret = key.encode()
    if not secret:
        raise ValueError("surrogates need a key")
    block = (hashlib.sha256(secret).digest() if len(secret) > 64 else secret).ljust(64, b"\0")
    inner, outer = (F.lit(bytes(b ^ pad for b in block)) for pad in (0x36, 0x5C))
    entity = F.concat_ws("|", kind, normal_form(kind, mention), attempt.cast("string"))
    return F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, F.encode(entity, "UTF-8")), 256))), 256)


def _check_sum(number: Column) -> Column:
    """The last digit of the sum of a number's digits, every second one from the right doubled and its digits added."""
    digits = F.reverse(F.transform(F.regexp_extract_all(number, F.lit("[0-9]"), F.lit(0)), lambda d: d.cast("int")))
    terms = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2))
    return F.aggregate(terms, F.lit(0), lambda total, t: total + t) % 10


def _card(mention: Column, digest: Column, attempt: Column) -> Column:
    """A number with the card's first digit and groups; its check digit fits if the card's does."""

    def checked(e):
        kept = F.char_length(e["made"]) - 1
        right = (F.substr(e["made"], kept + 1).cast("int") + 10 - _check_sum(e["made"])) % 10
        return F.when(e["fits"], F.concat(F.substr(e["made"], F.lit(1), kept), right.cast("string"))).otherwise(e["made"])

    made = _longer(_shaped(mention, digest, "^[0-9]"), digest, attempt, "0123456789")
    once = F.struct(made.alias("made"), (_check_sum(mention) == 0).alias("fits"))
    return F.get(F.transform(F.array(once), checked), F.lit(0))


def surrogate(kind: Column, mention: Column, attempt: Column, gender: Column, digest: Column) -> Column:
    """The mention's replacement: a function of the entity (its digest and gender) and the attempt, in the mention's format.
    Its normal form is the same for every spelling of the entity."""
    octets = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: _number(digest, i, 256).cast("string"))
    local, domain = F.substring_index(mention, "@", 1), F.substring_index(mention, "@", -1)
    host, suffix = F.regexp_extract(domain, r"^(.*)(\.[^.]*)$", 1), F.regexp_extract(domain, r"^(.*)(\.[^.]*)$", 2)
    return (
        F.when(kind == "email", F.concat(_shaped(F.concat(local, F.lit("@"), _longer(host, digest, attempt, "abcdefghijklmnopqrstuvwxyz")), digest), suffix))
        .when(kind == "ipv4", F.array_join(octets, "."))
        .when(kind == "name", _name(mention, digest, gender, attempt))
        .when(kind == "card", _card(mention, digest, attempt))
        .when(kind == "phone", _longer(_shaped(mention, digest, COUNTRY), digest, attempt, "0123456789"))
        .otherwise(_longer(_shaped(mention, digest), digest, attempt, "0123456789"))
    )


def _mentions(text: Column) -> Column:
    """The entities of a text in order, as (type, mention)."""
    found = F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))
    return F.when(text.rlike(HINT), F.transform(found, lambda m: F.struct(entity_type(m).alias("kind"), m.alias("mention"))))


def exceptions(entities: DataFrame, key: str) -> DataFrame:
    """(kind, normal, attempt, gender) of the entities that may not use their first surrogate, or whose mentions' titles do
    not all tell the entity's gender.

    ``entities``: distinct (kind, normal, like, gender, varied), like being any of the entity's spellings: all are rendered to
    one normal form. An entity moves on while a surrogate of its type has an earlier entity, by attempt and name, or equals
    an entity of the corpus. Late surrogates are longer, so every entity finds one, however many of a form there are; only
    IPv4 addresses keep their length, of which four billion exist."""
    own = ("kind", "normal", "like", "gender", "varied")
    state = stored(entities.withColumn("attempt", F.lit(0)), "entities")
    while True:
        digest = entity_digest(F.col("kind"), F.col("like"), F.col("attempt"), key)
        # bound once: made anew for each sign, the digest of a long mention would take the square of its length
        once = F.array(F.struct("kind", "like", "attempt", "gender", digest.alias("digest")))
        to = F.transform(once, lambda e: normal_form(e["kind"], surrogate(e["kind"], e["like"], e["attempt"], e["gender"], e["digest"])))
        made = state.withColumn("to", F.get(to, F.lit(0)))
        first = Window.partitionBy("kind", "to").orderBy(F.desc("attempt"), "normal")
        real = state.select("kind", F.col("normal").alias("to"), F.lit(True).alias("real"))
        checked = made.withColumn("rank", F.row_number().over(first)).join(real, ["kind", "to"], "left")
        moved = checked.select(*own, "attempt", ((F.col("rank") > 1) | F.coalesce("real", F.lit(False))).alias("again"))
        moved = stored(moved, "checked")
        if moved.filter("again").isEmpty():
            break
        state = stored(moved.select(*own, (F.col("attempt") + F.col("again").cast("int")).alias("attempt")), "entities")
    return state.filter("attempt > 0 OR varied").select("kind", "normal", "attempt", "gender")


def replaced(docs: DataFrame, key: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with its text replaced and ``n_entities`` (replaced if there is one), the number of mentions. ``key`` is a secret:
    with it surrogates can be made again, without it not; an empty one is refused.

    Null texts stay null, empty ones empty. Repeated rows and copies get the same surrogates, since these depend on the
    entity alone. One entity may stand in any share of the rows: entities are made distinct in the map tasks first.
    A name's gender is what its titles tell in the whole corpus; where they tell both or none it has the neutral ending. Only
    rows with an entity whose surrogate collided, or with a title that does not tell its entity's gender, are looked up by
    id; a null id is looked up like any other.
    """
    found = docs.select(F.col(f"`{doc_id}`").alias("id"), F.explode(_mentions(F.col(f"`{text}`"))).alias("m")).select("id", "m.*")
    found = found.withColumns({"normal": normal_form(F.col("kind"), F.col("mention")), "told": _gender(F.col("kind"), F.col("mention"))})
    found = stored(found, "mentions")
    lowest, male = F.min("told"), F.max((F.col("told") == 1).cast("int")) == 1
    gender = F.when((lowest == 0) & male, 2).when(lowest == 0, 0).when(male, 1).otherwise(2)
    entities = found.groupBy("kind", "normal").agg(F.min("mention").alias("like"), gender.alias("gender"), (lowest != F.max("told")).alias("varied"))
    moved = stored(exceptions(entities, key), "exceptions")
    out = docs.withColumn("__found", _mentions(F.col(f"`{text}`")))
    nothing = F.lit(None).cast("struct<attempt: int, gender: int>")
    entry = lambda m: nothing
    if not moved.isEmpty():
        name = lambda kind, normal: F.concat_ws("|", kind, normal)
        used = found.join(moved, ["kind", "normal"]).filter("attempt > 0 OR told != gender")
        used = used.select("id", name(F.col("kind"), F.col("normal")).alias("n"), F.struct("attempt", "gender").alias("e")).distinct()
        # by id and bounded by the distinct entities of that id's texts
        maps = used.groupBy("id").agg(F.map_from_entries(F.collect_set(F.struct("n", "e"))).alias("__moved"))
        out = out.join(maps, out[doc_id].eqNullSafe(maps["id"]), "left").drop(maps["id"])
        entry = lambda m: F.col("__moved")[name(m["kind"], normal_form(m["kind"], m["mention"]))]
    known = F.transform("__found", lambda m: F.struct(m["kind"].alias("kind"), m["mention"].alias("mention"), entry(m).alias("e")))
    known = F.transform(known, lambda m: F.struct(
        m["kind"].alias("kind"), m["mention"].alias("mention"), F.coalesce(m["e"]["attempt"], F.lit(0)).alias("attempt"),
        F.coalesce(m["e"]["gender"], _gender(m["kind"], m["mention"])).alias("gender"),
    ))
    keyed = F.transform(known, lambda m: F.struct(m.alias("m"), entity_digest(m["kind"], m["mention"], m["attempt"], key).alias("digest")))
    made = F.transform(keyed, lambda x: surrogate(x["m"]["kind"], x["m"]["mention"], x["m"]["attempt"], x["m"]["gender"], x["digest"]))
    pieces = F.split(F.col(f"`{text}`"), ENTITY, -1)
    filled = F.zip_with(pieces, made, lambda p, s: F.concat(p, F.coalesce(s, F.lit(""))))
    n = F.coalesce(F.size("__found"), F.lit(0))
    changed = F.when(F.size("__found") > 0, F.array_join(filled, "")).otherwise(F.col(f"`{text}`"))
    return out.withColumns({text: changed, "n_entities": n}).drop("__found", "__moved")
