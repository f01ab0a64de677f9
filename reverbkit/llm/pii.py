r"""PII: surrogate generation with DataFrame functions only.

Entities are found by one regular expression (email, IPv4, IBAN, US social
security number, payment card, phone, person after a form of address). Every
distinct entity of the corpus, in a normal form (digits only, lower case, bare
name), gets one surrogate, a keyed hash spelled in the entity's own shape:

* digits become digits, letters become letters of the same case and script
  (Latin, Greek, Cyrillic), all other characters stay, so each occurrence
  keeps its own separators; a repeated entity gets the same surrogate in every
  document and format (coreference);
* cards keep their first digit and a valid (or invalid) check digit, phones
  their country code, IP numbers stay numbers up to 255, emails their top-level
  domain, IBANs their country;
* persons keep their form of address; first names change within their gender
  and script (Latin, Greek, Cyrillic; others get Latin names), surnames, the
  last word, within their script, each on its own: a surname has one surrogate
  with any first name and form of address. A first name after a neutral form of
  address has the gender that the text, or else the corpus, gives it if that is
  one only;
* within a text that holds a person after a form of address, that person's full
  name and surname without one are replaced alike (not counted as entities).

Surrogates must differ from each other and from every real entity of the same
type (collision check): losers draw again with the next attempt number until
none is left; from the fourth attempt on names become longer and emails get
digits, so there is always room; after ``MAX_ATTEMPTS`` draws the job fails
rather than reuse a surrogate.

The texts are searched once: the rows are written with the entities found in
them, and all that follows reads that table. Texts without an entity are not
shuffled. For the others the surrogates are joined on the entity and gathered per text; an entity that a third of all rows
share is one row of the surrogate table and a join key that Spark can split.

Defined results: null texts stay null, empty ones empty; repeated rows get the
same new text; a null id is no obstacle (texts, not ids, are the key); an empty
table gives an empty result. All columns of the input are returned, the text
replaced; internal columns start with ``_pii_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reverbkit.llm.common import cut_lineage

MAX_ATTEMPTS = 64
KEY = "reverbkit"
#: The country codes of the numbering plan, of one and of two digits; the others have three.
COUNTRY = "^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"

OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
TITLES_F = ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа"]
TITLES_M = ["Mr", "Sir", "Herr", "Monsieur", "Señor", "Sr", "Господин"]
TITLES_N = ["Dr", "Prof"]
NAME = "\\p{Lu}[\\p{Ll}]++(?:[-'’]\\p{Lu}[\\p{Ll}]++){0,2}"
#: In the order in which they are tried.
PATTERNS = {
    "email": "(?<![\\p{L}\\p{N}._%+-])[\\p{L}\\p{N}_%+-](?:[\\p{L}\\p{N}._%+-]{0,63}[\\p{L}\\p{N}_%+-])?@(?:[\\p{L}\\p{N}-]{1,63}\\.){1,8}\\p{L}{2,24}",
    "ip": f"(?<![0-9.])(?:{OCTET}\\.){{3}}{OCTET}(?![0-9]|\\.[0-9])",
    "iban": "(?<![\\p{L}\\p{N}])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\\p{L}\\p{N}])",
    "ssn": "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": "(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
    "phone": "(?<![0-9+])(?:\\+1[ .-]?)?(?:\\([0-9]{3}\\)|[0-9]{3})[ .-]?[0-9]{3}[ .-][0-9]{4}(?![0-9])"
    "|(?<![0-9+])\\+[0-9]{1,3}(?:[ .-]?\\([0-9]{1,4}\\))?(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])"
    "|(?<![0-9+])\\+[0-9]{1,3}[ .-][0-9](?:[ .-][0-9]{2,4}){2,4}(?![0-9])",
    "person": "(?<![\\p{L}\\p{N}])(?:" + "|".join(TITLES_F + TITLES_M + TITLES_N) + f")\\.? {NAME}(?: {NAME}){{0,2}}(?!\\p{{L}})",
}
PATTERNS = {k: p.replace("([ -])", "[ -]") for k, p in PATTERNS.items()}
ANY = "|".join(PATTERNS.values())
#: Every entity holds a digit, an @ or a form of address: texts without these are not searched.
HINT = "[0-9@]|(?=[MSFHDPГ])(?:" + "|".join(TITLES_F + TITLES_M + TITLES_N) + ")\\.? \\p{Lu}"

#: Fixed name lists of the surrogates; gender, script.
FIRST = {
    ("f", "latin"): "Alma Berta Clara Dora Edith Flora Greta Hilda Irma Julia Karla Lena Marta Nora Olga Paula Rita Sara Thea Vera",
    ("m", "latin"): "Adam Bruno Carl Denis Emil Frank Georg Hugo Ivan Jonas Kurt Leon Max Nils Oskar Paul Ralf Simon Theo Viktor",
    ("f", "greek"): "Αθηνά Βασιλική Γεωργία Δήμητρα Ελένη Ζωή Ιωάννα Κατερίνα Μαρία Νίκη Ουρανία Σοφία",
    ("m", "greek"): "Αλέξης Βασίλης Γιώργος Δημήτρης Ηλίας Θωμάς Κώστας Λευτέρης Μιχάλης Νίκος Πέτρος Σπύρος",
    ("f", "cyrillic"): "Анна Вера Дарья Елена Жанна Зоя Ирина Клара Лидия Мария Нина Ольга Полина Раиса Софья Тамара",
    ("m", "cyrillic"): "Антон Борис Вадим Глеб Денис Егор Захар Иван Кирилл Леонид Максим Никита Олег Павел Роман Семён",
}
LAST = {
    "latin": "Abel Berger Castell Dorn Ehrlich Falk Garner Holm Ilves Jansen Keller Lorenz Moreau Novak Ortega Perrin Quist Rivera Sauer Thorne Ulmer Vidal Weiss Yates Zander",
    "greek": "Αγγέλου Βλάχου Γεωργίου Δούκα Ζέρβα Θεοδώρου Ιωάννου Κωνσταντίνου Λάμπρου Μακρή Νικολάου Παππά",
    "cyrillic": "Абрамов Белов Волков Громов Данилов Ершов Жуков Зимин Ильин Крылов Лебедев Морозов Новик Орлов Петрук Рогов",
}
ALPHABETS = ["abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщъыьэюя", "αβγδεζηθικλμνξοπρστυφχψω"]


SCRIPTS = {"cyrillic": "norm rlike '\\\\p{IsCyrillic}'", "greek": "norm rlike '\\\\p{IsGreek}'"}
SCRIPTS["latin"] = "not (" + " or ".join(SCRIPTS.values()) + ")"
#: Words that may be names without a form of address.
BARE = f"(?<![\\p{{L}}\\p{{N}}]){NAME}(?: {NAME})*+(?!\\p{{L}})"


def _kind(raw: Column) -> Column:
    kinds = [F.when(F.regexp_like(raw, F.lit(f"^(?:{p})$")), F.lit(k)) for k, p in PATTERNS.items()]
    # lookarounds see only the entity itself here; what matched as a whole is of the first kind that fits
    return F.coalesce(*kinds, F.lit("phone"))


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _normal(kind: Column, raw: Column) -> Column:
    """What an entity's occurrences have in common."""
    name = F.regexp_replace(raw, "^\\S+ ", "")
    return (
        F.when(kind == "email", F.lower(raw))
        .when(kind == "person", F.concat(_gender(raw), F.lit(" "), name))
        .when(kind == "phone", _subscriber(raw))
        .when(kind == "iban", F.upper(F.regexp_replace(raw, " ", "")))
        .when(kind == "ip", raw)
        .otherwise(_digits(raw))
    )


def _subscriber(raw: Column) -> Column:
    """A phone number's digits without its country code. Of fewer than seven
    digits there would be too few surrogates: then the code counts as a part."""
    digits = _digits(raw)
    bare = F.regexp_replace(digits, COUNTRY, "")
    return F.when(F.startswith(raw, F.lit("+")) & (F.length(bare) >= 7), bare).otherwise(digits)


def _gender(raw: Column) -> Column:
    title = F.regexp_extract(raw, "^(\\p{L}+)", 1)
    return F.when(title.isin(TITLES_F), "f").when(title.isin(TITLES_M), "m").otherwise("n")


def _byte(digest: str, i: str) -> str:
    """SQL: the i-th (from 0) hash byte of a hex string of 64 bytes, round and round."""
    return f"cast(conv(substr({digest}, 2 * (({i}) % 64) + 1, 2), 16, 10) as int)"


def _respell(text: str, digest: str) -> str:
    """SQL: ``text`` with digits and letters replaced within their own alphabet."""
    cases = ["when c rlike '[0-9]' then cast({b} % 10 as string)"]
    for a in ALPHABETS:
        for letters in (a, a.upper()):
            cases.append(f"when instr('{letters}', c) > 0 then substr('{letters}', 1 + {{b}} % {len(letters)}, 1)")
    cases.append("when c rlike '\\\\p{{Lu}}' then substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', 1 + {b} % 26, 1)")
    cases.append("when c rlike '\\\\p{{L}}' then substr('abcdefghijklmnopqrstuvwxyz', 1 + {b} % 26, 1)")
    body = " ".join(cases).format(b=_byte(digest, "i"))
    return f"array_join(transform(regexp_extract_all({text}, '(?s).', 0), (c, i) -> case {body} else c end), '')"


def _pick(names: str, digest: str, at: int) -> str:
    n = len(names.split())
    return f"split('{names}', ' ')[{_byte(digest, str(at))} % {n}]"


LUHN = (
    "aggregate(transform(sequence(1, length(d)), i -> case when i % 2 = 0 then cast(substr(reverse(d), i, 1) as int)"
    " else 2 * cast(substr(reverse(d), i, 1) as int) - if(substr(reverse(d), i, 1) > '4', 9, 0) end), 0, (s, x) -> s + x)"
)


def _luhn(body: str) -> str:
    """SQL: the check digit of a digit string without it."""
    return f"cast((10 - {LUHN.replace('(d)', f'({body})')} % 10) % 10 as string)"


def _draw(key: str) -> Column:
    """The surrogate of (kind, norm) at its attempt, in the normal form."""
    h = "h"  # the keyed digest, a column
    person, given_name, surname = ["case"], ["case"], ["case"]
    for (g, script), first in FIRST.items():
        test = SCRIPTS[script]
        gender = f"(substr(norm, 1, 1) = '{g}' or (substr(norm, 1, 1) = 'n' and {_byte(h, '9')} % 2 = {int(g == 'm')}))"
        given, sur = _pick(first, h, 0), _pick(LAST[script], h, 1)
        longer = f"transform(sequence(1, cast(attempt / 4 as int)), k -> {_pick('{names}', h, 0).replace(_byte(h, '0'), _byte(h, 'k + 1'))})"

        def grown(name: str, names: str, longer: str = longer) -> str:
            more = longer.replace("{names}", names).replace("% 1]", f"% {len(names.split())}]")
            return f"case when attempt < 4 then {name} else concat({name}, '-', array_join({more}, '-')) end"

        full = f"case when size(split(norm, ' ')) > 2 then concat({given}, ' ', {grown(sur, LAST[script])}) else {grown(sur, LAST[script])} end"
        person.append(f"when {test} and {gender} then concat(substr(norm, 1, 1), ' ', {full})")
        given_name.append(f"when {test} and {gender} then {grown(given, first)}")
        surname.append(f"when {test} then {grown(sur, LAST[script])}")
    for names in (person, given_name, surname):
        names.append("end")
    local, host = "substring_index(norm, '@', 1)", "substring_index(norm, '@', -1)"
    name = "substr({0}, 1, length({0}) - length(substring_index({0}, '.', -1)))".format(host)
    email = (
        f"concat({_respell(local, h)}, case when attempt < 4 then '' else substr(translate({h}, 'abcdef', '123456'), 1, attempt) end, '@',"
        f" {_respell(name, 'hd')}, substring_index({host}, '.', -1))"
    )
    octets = f"array_join(transform(split(norm, '[.]'), (o, i) -> cast(if(i = 0, 1 + {_byte(h, 'i')} % 223, {_byte(h, 'i')}) as string)), '.')"
    digits = _respell("norm", h)
    card = f"concat(substr(norm, 1, 1), substr({digits}, 2, length(norm) - 2))"
    check = _luhn("substr(norm, 1, length(norm) - 1)")
    valid = f"substr(norm, -1) = {check}"
    card_check = _luhn("card")
    phone = f"concat(if(length(norm) = 10 and substr(norm, 1, 1) > '1', cast(2 + {_byte(h, '60')} % 8 as string), substr({digits}, 1, 1)), substr({digits}, 2))"
    iban = f"concat(substr(norm, 1, 2), substr({digits}, 3))"
    return F.expr(
        f"case kind when 'person' then {' '.join(person)} when 'first' then {' '.join(given_name)} when 'last' then {' '.join(surname)} when 'email' then {email} when 'ip' then {octets}"
        f" when 'phone' then {phone} when 'iban' then {iban}"
        f" when 'card' then transform(array({card}), card -> concat(card, if({valid}, {card_check}, cast(({card_check} + 1 + {_byte(h, '61')} % 9) % 10 as string))))[0]"
        f" else {digits} end"
    )


def _attempt(entities: DataFrame, key: str) -> DataFrame:
    """Draws ``surrogate`` for the rows (kind, norm, attempt)."""
    secret = F.lit(key)
    hashed = entities.withColumn("h", F.sha2(F.concat_ws("\u0001", secret, "kind", "norm", F.col("attempt").cast("string")), 512))
    hashed = hashed.withColumn("hd", F.sha2(F.concat_ws("\u0001", secret, F.lit("host"), F.substring_index("norm", "@", -1)), 512))
    return hashed.withColumn("surrogate", _draw(key)).select("kind", "norm", "attempt", "surrogate")


def surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, norm, surrogate) for distinct (kind, norm): no two surrogates of a
    kind are equal and none equals a real entity of that kind."""
    drawn = cut_lineage(_attempt(entities.select("kind", "norm").distinct().withColumn("attempt", F.lit(0)), key), "pii-draw")
    for _ in range(MAX_ATTEMPTS):
        # first names are spelled without their gender
        real = drawn.select("kind", F.expr("if(kind = 'first', substr(norm, 3), norm)").alias("surrogate")).distinct().withColumn("real", F.lit(True))
        winner = drawn.groupBy("kind", "surrogate").agg(F.min(F.struct((-F.col("attempt")).alias("a"), "norm"))["norm"].alias("winner"))
        judged = drawn.join(winner, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left")
        judged = judged.withColumn("lost", (F.col("winner") != F.col("norm")) | F.coalesce("real", F.lit(False)))
        judged = cut_lineage(judged.select("kind", "norm", "attempt", "surrogate", "lost"), "pii-judged")
        if judged.where("lost").isEmpty():
            return drawn.select("kind", "norm", "surrogate")
        again = _attempt(judged.where("lost").select("kind", "norm", (F.col("attempt") + 1).alias("attempt")), key)
        drawn = cut_lineage(judged.where("not lost").drop("lost").unionByName(again), "pii-draw")
    raise RuntimeError("no distinct surrogates found")


def _dressed(kind: Column, raw: Column, surrogate: Column) -> Column:
    """The surrogate in the format of one occurrence."""
    digits = (
        "array_join(transform(sequence(1, length(raw)), i -> case when not substr(raw, i, 1) rlike '[0-9]' then substr(raw, i, 1)"
        " when length(regexp_replace(substr(raw, 1, i), '[^0-9]', '')) + length(surrogate) <= length(regexp_replace(raw, '[^0-9]', ''))"
        " then substr(raw, i, 1) else substr(surrogate, length(regexp_replace(substr(raw, 1, i), '[^0-9]', ''))"
        " + length(surrogate) - length(regexp_replace(raw, '[^0-9]', '')), 1) end), '')"
    )
    spaced = (
        "array_join(transform(sequence(1, length(raw)), i -> if(substr(raw, i, 1) = ' ', ' ',"
        " substr(surrogate, length(replace(substr(raw, 1, i), ' ', '')), 1))), '')"
    )
    title = F.concat(F.regexp_extract(raw, "^(\\S+ )", 1), F.substring(surrogate, 3, 1 << 20))
    upper = F.when(raw == F.upper(raw), F.upper(surrogate)).otherwise(surrogate)
    return (
        F.when(kind == "email", upper)
        .when(kind == "person", title)
        .when(kind == "ip", surrogate)
        .when(kind == "iban", F.expr(spaced))
        .otherwise(F.expr(digits))
    )


def replace_pii(docs: DataFrame, text_col: str = "text", key: str = KEY, count_col: str | None = "n_entities") -> DataFrame:
    """``docs`` with every detected entity replaced, and the number of entities
    (0 for null) in the column ``count_col``, which ``docs`` must not have; None: not told."""
    if count_col in docs.columns:
        raise ValueError(f"the input has a column {count_col}; name another for the number of entities")
    hinted = F.expr(f"`{text_col}` rlike r'{_sql(HINT)}'")
    entities = F.when(hinted, F.expr(f"regexp_extract_all(`{text_col}`, r'{_sql(ANY)}', 0)"))
    found = cut_lineage(docs.withColumn("_pii_found", F.coalesce(entities, F.array().cast("array<string>"))), "pii-found")
    with_any = found.where(F.size("_pii_found") > 0).withColumn("_pii_key", F.sha2(F.col(text_col), 256))
    raws = with_any.select("_pii_key", F.explode(F.array_distinct("_pii_found")).alias("raw")).distinct()
    raws = raws.withColumn("kind", _kind(F.col("raw"))).withColumn("norm", _normal(F.col("kind"), F.col("raw")))
    raws = cut_lineage(raws, "pii-entities")
    parts = cut_lineage(_name_parts(raws.where("kind = 'person'")), "pii-names")
    raws = raws.where("kind <> 'person'")
    named = surrogates(raws.select("kind", "norm").unionByName(parts.select("kind", "norm")), key)
    spelled = cut_lineage(
        raws.select("raw", "kind", "norm").distinct().join(named, ["kind", "norm"]).select("raw", _dressed(F.col("kind"), F.col("raw"), F.col("surrogate")).alias("new")), "pii-spelled"
    )
    persons, bare = _renamed(parts.join(named, ["kind", "norm"]))
    spelled = raws.join(spelled, "raw").select("_pii_key", "raw", "new").unionByName(persons)
    by_text = spelled.groupBy("_pii_key").agg(F.map_from_entries(F.collect_set(F.struct("raw", "new"))).alias("_pii_map"))
    by_text = by_text.join(bare, "_pii_key", "left")
    gaps = F.expr(f"split(`{text_col}`, r'{_sql(ANY)}', -1)")
    rebuilt = with_any.join(by_text, "_pii_key").withColumn("_pii_gaps", gaps)
    new = F.expr(f"array_join(transform(_pii_gaps, (g, i) -> concat({_bare("g")}, coalesce(_pii_map[get(_pii_found, i)], ''))), '')")
    columns = [F.col(f"`{c}`") if c != text_col else new.alias(text_col) for c in docs.columns]
    told = [F.size("_pii_found").alias(count_col)] if count_col else []
    rebuilt = rebuilt.select(*columns, *told)
    rest = found.where(F.size("_pii_found") == 0).select(*[F.col(f"`{c}`") for c in docs.columns], *([F.lit(0).alias(count_col)] if count_col else []))
    return rebuilt.unionByName(rest)


def _name_parts(persons: DataFrame) -> DataFrame:
    """(_pii_key, raw, words, pos, kind, norm) of each word of the names: kind
    ``last`` with the word as norm, or ``first`` with gender and word."""
    words = persons.select("_pii_key", "raw", _gender(F.col("raw")).alias("gender"), F.split(F.regexp_replace("raw", "^\\S+ ", ""), " ").alias("words"))
    parts = words.select("*", F.posexplode("words").alias("pos", "word")).withColumn("is_last", F.expr("pos = size(words) - 1"))
    last = parts.where("is_last").select("_pii_key", "raw", "words", "pos", F.lit("last").alias("kind"), F.col("word").alias("norm"))
    first = parts.where("not is_last")
    one = F.expr("if(min(gender) = max(gender), min(gender), null)")
    known = first.where("gender <> 'n'")
    in_text = known.groupBy("_pii_key", "word").agg(one.alias("in_text"))
    anywhere = known.groupBy("word").agg(one.alias("anywhere"))
    told = first.join(in_text, ["_pii_key", "word"], "left").join(anywhere, "word", "left")
    gender = F.when(F.col("gender") == "n", F.coalesce("in_text", "anywhere", "gender")).otherwise(F.col("gender"))
    return last.unionByName(told.select("_pii_key", "raw", "words", "pos", F.lit("first").alias("kind"), F.concat(gender, F.lit(" "), "word").alias("norm")))


def _renamed(parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(_pii_key, raw, new) of the persons, and (_pii_key, _pii_bare): for each
    text what replaces a surname, and a first name that stands before the rest
    of the name (the words, joined, are the key)."""
    names = F.array_sort(F.collect_set(F.struct("pos", "surrogate")))["surrogate"]
    persons = parts.groupBy("_pii_key", "raw").agg(F.concat(F.regexp_extract("raw", "^(\\S+ )", 1), F.array_join(names, " ")).alias("new"))
    spans = F.expr("array_distinct(array(array_join(slice(words, pos + 1, 3), ' '), if(pos = 0 and size(words) > 2, concat(words[0], ' ', words[size(words) - 1]), array_join(slice(words, pos + 1, 3), ' '))))")
    bare = parts.select("_pii_key", F.explode(spans).alias("bare"), "surrogate").groupBy("_pii_key", "bare").agg(F.min("surrogate").alias("new"))
    return persons, bare.groupBy("_pii_key").agg(F.map_from_entries(F.collect_list(F.struct("bare", "new"))).alias("_pii_bare"))


def _bare(gap: str) -> str:
    """SQL: the text between two entities with the names of ``_pii_bare`` replaced."""
    words = "split(s, ' ')"
    triples = f"zip_with(zip_with({words}, slice({words}, 2, length(s)), (a, b) -> struct(a, b)), slice({words}, 3, length(s)), (ab, c) -> struct(ab.a, ab.b, c))"
    new = "coalesce(_pii_bare[concat_ws(' ', w.a, w.b, w.c)], _pii_bare[concat_ws(' ', w.a, w.b)], _pii_bare[w.a], w.a)"
    renamed = f"array_join(transform({triples}, w -> {new}), ' ')"
    pattern = _sql(BARE)
    return (
        f"if(_pii_bare is null, {gap}, array_join(zip_with(split({gap}, r'{pattern}', -1), regexp_extract_all({gap}, r'{pattern}', 0),"
        f" (t, s) -> concat(t, if(s is null, '', {renamed}))), ''))"
    )


def _sql(pattern: str) -> str:
    return pattern.replace("'", "\\x27")
