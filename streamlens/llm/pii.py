"""Personal data: detected entities get keyed surrogates of the same type, format, script and gender.

Detection, surrogates and replacement are column expressions; there is no Python in the tasks.

* The same entity gets the same surrogate in every document (case and separators do not matter), so mentions
  still refer to each other. A phone number is known by its last ten digits, a person by surname and given name.
* What only looks like an entity stays: card numbers need a right check digit and a first digit of an issuer, account
  numbers (IBAN) right check digits, and a key after the word commit is the id of a commit.
* A surrogate keeps what its type shows: digits stay digits in the same layout, hexadecimal keys stay hexadecimal in
  their case, card and account numbers get right check digits, addresses keep valid octets, names keep
  script and capitals and the gender that their title states.
* Collision checks: within a kind no two entities share a surrogate and none is an entity of the corpus.
  Losers of a round take the next candidate; rounds go on until none is left.

A null text stays null, an empty one empty. Texts without entities are unchanged. The work on a text grows with its length and
the number of its entities, not with their square; the patterns run over each text once. ``n_entities`` counts replaced entities; a column
of that name in the input is replaced. Repeated rows are all kept, null keys too: rows are told apart by number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamlens.session import pin

MALE = ("Mr", "Herr", "Monsieur", "Señor", "Господин")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "Госпожа")
EITHER = ("Dr", "Prof")
TITLE = rf"(?:{'|'.join((*MALE, *FEMALE, *EITHER))})"
#: In this order: the first that matches at a place wins.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "secret": r"\b(?<![Cc]ommit )(?:[0-9a-f]{32,}|[0-9A-F]{32,}|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,})\b",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "phone": r"(?:\+\d{1,3}[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}(?!\d)|\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\d-])\d{3}[ .-]\d{3}[ .-]\d{4}(?![\d-])",
    "card": r"(?<![\d.-])(?=[2-6])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{4,5})(?![\d]|[.-]\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "name": rf"(?<!\p{{L}}){TITLE}\.? \p{{Lu}}\p{{L}}+(?: \p{{Lu}}\p{{L}}+)?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
HINT = rf"[0-9@]|{TITLE}|AKIA|gh[pousr]_|sk-|xox[abprs]-|[a-f]{{32}}|[A-F]{{32}}"

_LATIN = "ba be bo da de do fa fe ga ka ke la le li lo ma me mi mo na ne ni no pa pe ra re ri ro sa se si so ta te ti to va ve vi".split()
_CYRILLIC = "ба бе бо да де до фа га ка ке ла ле ли ло ма ме ми мо на не ни но па пе ра ре ри ро са се си со та те ти то ва ве ви зо".split()


def _array(values: list[str]) -> str:
    return "array(" + ", ".join(f"'{v}'" for v in values) + ")"


# Byte i (from 0) of the keyed stream of a row, as a number.
_BYTE = "cast(conv(substr(stream, 2 * (%s) + 1, 2), 16, 10) AS int)"
_SYLLABLES = (
    "concat_ws('', transform(sequence(0, {n} - 1), i -> get(CASE WHEN canon RLIKE '\\\\p{{IsCyrillic}}' THEN "
    + _array(_CYRILLIC) + " ELSE " + _array(_LATIN) + " END, " + _BYTE % "i" + " % 40)))"
)
# A row has kind, canon, attempt and stream (keyed hex digits, two for each letter and more).
CANDIDATE = f"""
CASE
  WHEN kind = 'ip' THEN concat_ws('.', transform(sequence(0, 3), i -> 1 + {_BYTE % 'i'} % 254))
  WHEN kind = 'secret' AND canon RLIKE '^[0-9a-f]+$' THEN substr(stream, 1, length(canon))
  WHEN kind = 'secret' AND canon RLIKE '^[0-9A-F]+$' THEN upper(substr(stream, 1, length(canon)))
  WHEN kind IN ('phone', 'card', 'ssn') THEN
    concat_ws('', transform(sequence(0, length(canon) - 1), i -> {_BYTE % 'i'} % 10))
  WHEN kind = 'surname' THEN {_SYLLABLES.format(n="(3 + attempt div 4)")}
  WHEN kind = 'given f' THEN concat({_SYLLABLES.format(n="(2 + attempt div 4)")}, CASE WHEN canon RLIKE '\\\\p{{IsCyrillic}}' THEN 'на' ELSE 'na' END)
  WHEN kind = 'given m' THEN concat({_SYLLABLES.format(n="(2 + attempt div 4)")}, CASE WHEN canon RLIKE '\\\\p{{IsCyrillic}}' THEN 'р' ELSE 'r' END)
  WHEN kind = 'given' THEN {_SYLLABLES.format(n="(2 + attempt div 4)")}
  ELSE concat(
    CASE WHEN kind = 'email' AND attempt > 3 THEN concat(substr(stream, 1, 8), '.') ELSE '' END,
    concat_ws('', transform(split(canon, ''), (c, i) -> CASE
      WHEN kind = 'iban' AND i < 2 OR kind = 'secret' AND i < 4 THEN c
      WHEN kind = 'email' AND i >= length(canon) - length(substring_index(canon, '.', -1)) THEN c
      WHEN c RLIKE '[0-9]' THEN cast({_BYTE % 'i'} % 10 AS string)
      WHEN c RLIKE '[a-z]' THEN chr(97 + {_BYTE % 'i'} % 26)
      WHEN c RLIKE '[A-Z]' THEN chr(65 + {_BYTE % 'i'} % 26)
      ELSE c END)))
END
"""
# Sum of digits with every second one, from the right, doubled; a number is right if this is a multiple of ten.
_CHECK = """aggregate(transform(split(%s, ''), (c, i) -> CASE WHEN (length(%s) - i) %% 2 = 0
  THEN (2 * cast(c AS int)) div 10 + (2 * cast(c AS int)) %% 10 ELSE cast(c AS int) END), 0L, (a, x) -> a + x)"""
# The remainder by 97 of an account number with country and check digits at its end, a letter counting from 10 on.
_ACCOUNT = """aggregate(split(concat(substr(%s, 5), substr(%s, 1, 2), %s), ''), 0L, (a, c) -> CASE WHEN c RLIKE '[0-9]'
  THEN (a * 10 + cast(c AS int)) %% 97 ELSE (a * 100 + ascii(c) - 55) %% 97 END)"""
RIGHT = f"""
CASE WHEN kind = 'card' THEN {_CHECK % ('canon', 'canon')} % 10 = 0
     WHEN kind = 'iban' THEN {_ACCOUNT % ('canon', 'canon', 'substr(canon, 3, 2)')} = 1
     ELSE true END
"""
CHECKED = f"""
CASE WHEN kind = 'card' THEN
  transform(array(concat(substr(candidate, 1, length(candidate) - 1), '0')), z ->
    concat(substr(z, 1, length(z) - 1), cast((10 - {_CHECK % ('z', 'z')} % 10) % 10 AS string)))[0]
  WHEN kind = 'iban' THEN concat(substr(candidate, 1, 2),
    lpad(cast(98 - {_ACCOUNT % ('candidate', 'candidate', "'00'")} AS string), 2, '0'), substr(candidate, 5))
ELSE candidate END
"""
# Digits of the surrogate go to the last places of digits in the text as it is written.
LAID_OUT = """
concat_ws('', transform(split(raw, ''), (c, i) -> CASE
  WHEN NOT c RLIKE '[0-9]' THEN c
  WHEN length(regexp_replace(substr(raw, i + 1), '[^0-9]', '')) > length(surrogate) THEN c
  ELSE substr(surrogate, length(surrogate) - length(regexp_replace(substr(raw, i + 1), '[^0-9]', '')) + 1, 1) END))
"""


def _kind() -> F.Column:
    out = None
    for kind, pattern in PATTERNS.items():
        hit = F.col("raw").rlike(rf"^(?:{pattern})$")
        out = F.when(hit, F.lit(kind)) if out is None else out.when(hit, F.lit(kind))
    return out.otherwise(F.lit("secret"))


def _parts() -> F.Column:
    """What must stay distinct and recur: one part per entity, given name and surname of a person."""
    raw, kind = F.col("raw"), F.col("kind")
    part = lambda k, canon, before, own: F.struct(k.alias("kind"), canon.alias("canon"), before.alias("before"), own.alias("raw"))
    title = F.regexp_extract(raw, rf"^({TITLE}\.? )", 1)
    bare = F.regexp_extract(raw, rf"^({TITLE})", 1)
    gender = F.when(bare.isin(*MALE), "given m").when(bare.isin(*FEMALE), "given f").otherwise("given")
    rest = F.regexp_replace(raw, rf"^{TITLE}\.? ", "")
    first, last = F.substring_index(rest, " ", 1), F.substring_index(rest, " ", -1)
    none = F.lit("")
    digits = F.regexp_replace(raw, "[^0-9]", "")
    canon = (
        F.when(kind == "email", F.lower(raw)).when(kind == "phone", F.right(digits, F.lit(10)))
        .when(kind.isin("card", "ssn"), digits).when(kind == "iban", F.regexp_replace(raw, " ", "")).otherwise(raw)
    )
    person = F.when(
        F.contains(rest, F.lit(" ")),
        F.array(part(gender, F.lower(first), title, first), part(F.lit("surname"), F.lower(last), F.lit(" "), last)),
    ).otherwise(F.array(part(F.lit("surname"), F.lower(last), title, last)))
    return F.when(kind == "name", person).otherwise(F.array(part(kind, canon, none, raw)))


def _candidates(entities: DataFrame, key: str) -> DataFrame:
    seed = F.concat_ws("|", F.lit(key), "kind", "canon", F.col("attempt").cast("string"))
    stream = F.transform(F.sequence(F.lit(0), F.ceil(F.char_length("canon") / 16).cast("int")), lambda k: F.sha2(F.concat_ws("|", seed, k.cast("string")), 256))
    made = entities.withColumn("stream", F.array_join(stream, "")).withColumn("candidate", F.expr(CANDIDATE))
    return made.withColumn("surrogate", F.expr(CHECKED)).select("kind", "canon", "attempt", "surrogate")


def surrogates(entities: DataFrame, key: str, patience: int = 64) -> DataFrame:
    """``kind``, ``canon``, ``surrogate`` for distinct ``kind``, ``canon``: no surrogate twice, none an entity.

    Fails only if ``patience`` rounds on end settle nothing, when a format has no free surrogates left.
    """
    settled, pending, idle = None, entities.withColumn("attempt", F.lit(0)), 0
    while True:
        made = _candidates(pending, key)
        taken = entities.select("kind", F.col("canon").alias("surrogate"))
        if settled is not None:
            taken = taken.unionByName(settled.select("kind", "surrogate"))
        order = Window.partitionBy("kind", "surrogate").orderBy("canon")
        ranked = made.withColumn("first", F.row_number().over(order) == 1)
        free = taken.withColumn("used", F.lit(True)).distinct()
        judged = pin(
            ranked.join(free, ["kind", "surrogate"], "left").withColumn("ok", F.col("first") & F.col("used").isNull()),
            "pii-surrogates",
        )
        won = judged.where("ok").select("kind", "canon", "surrogate")
        settled = won if settled is None else settled.unionByName(won)
        pending = judged.where("NOT ok").select("kind", "canon", (F.col("attempt") + 1).alias("attempt"))
        if pending.isEmpty():
            return settled
        idle = idle + 1 if won.isEmpty() else 0
        if idle == patience:
            raise RuntimeError(f"{patience} rounds settled no entity; their formats are too narrow for surrogates of their own")


def replace(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with surrogates in ``text`` and ``n_entities``. ``key`` is the secret of the replacements."""
    kept = [c for c in docs.columns if c not in ("n_entities", text)]
    found = F.when(F.col(text).rlike(HINT), F.regexp_extract_all(F.col(text), F.lit(ANY), F.lit(0)))
    shape = [*[F.col(c) for c in kept], F.col(text)]
    none = F.array().cast("array<string>")
    stored = pin(
        docs.select(F.struct(*shape).alias("row"), F.coalesce(found, none).alias("found"), F.monotonically_increasing_id().alias("rid")),
        "pii-docs",
    )
    with_some = stored.where(F.size("found") > 0)
    mentions = (
        with_some.select("rid", F.posexplode("found").alias("pos", "raw")).withColumn("kind", _kind())
        .select("rid", "pos", F.posexplode(_parts()).alias("part", "e"))
        .select("rid", "pos", "part", "e.*").withColumn("right", F.expr(RIGHT))
    )
    chosen = surrogates(pin(mentions.where("right").select("kind", "canon").distinct(), "pii-entities"), key)
    raw, new = F.col("raw"), F.col("surrogate")
    capital = F.concat(F.upper(F.substr(new, F.lit(1), F.lit(1))), F.substr(new, F.lit(2)))
    written = (
        F.when(F.col("kind").isin("phone", "card", "ssn"), F.expr(LAID_OUT))
        .when(F.col("kind").isin("surname", "given", "given m", "given f"), F.when((F.upper(raw) == raw) & (F.char_length(raw) > 1), F.upper(new)).otherwise(capital))
        .when((F.col("kind") == "email") & (F.upper(raw) == raw), F.upper(new))
        .when(F.col("kind") == "iban", F.expr("concat_ws('', transform(split(raw, ''), (c, i) -> CASE WHEN c = ' ' THEN c ELSE substr(surrogate, 1 + length(replace(substr(raw, 1, i), ' ', '')), 1) END))"))
        .otherwise(new)
    )
    # one shuffle by row: parts of an entity, then entities of a row, each in order
    by_entity = (
        mentions.join(chosen, ["kind", "canon"], "left")
        .select("rid", "pos", "right", F.struct("part", F.concat("before", F.when(F.col("right"), written).otherwise(raw)).alias("new")).alias("m"))
        .repartition("rid").groupBy("rid", "pos")
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list("m")), lambda m: m.new), "").alias("new"), F.bool_or("right").cast("int").alias("n"))
    )
    by_doc = by_entity.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("pos", "new"))).new.alias("per"), F.sum("n").cast("int").alias("n_entities"))
    text_of = F.col(f"row.`{text}`")
    rebuilt = F.array_join(F.zip_with(F.split(text_of, ANY, -1), F.col("per"), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    out = [F.col(f"row.`{c}`").alias(c) for c in kept]
    changed = with_some.join(by_doc, "rid").select(*out, rebuilt.alias(text), "n_entities")
    same = stored.where(F.size("found") == 0).select(*out, text_of.alias(text), F.lit(0).alias("n_entities"))
    return changed.unionByName(same).select(*[c for c in docs.columns if c != "n_entities"], "n_entities")
