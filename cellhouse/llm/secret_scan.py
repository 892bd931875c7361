"""Secret scans: candidates by pattern, false positives removed by a random
forest.  DataFrame functions and Spark ML only.

1. Candidates, by context: the password of ``user:password@`` in an address, and
   any value that a word of ``ANNOUNCES`` with ``=`` or ``:`` assigns (all that
   stands in its quotes; without quotes, up to a blank or quote, without the
   marks that end a sentence or list).  By form: runs of 16 or more of
   ``[A-Za-z0-9+/_-]`` (with trailing ``=``) that hold a digit.  One pattern matches
   announcement and value together and sets marks round the value, where the text is
   split: so a value may be of any length, and a text has its candidates with what
   stands before and after them in one pass.
2. Features of a candidate (``FEATURES``): its length; how its characters change
   class from place to place, character shares and variety; how much of it the
   dictionary covers; whether it stands in a path, address, number or id; and
   the words beside it (a name that announces a secret, or a harmless value, an
   assignment, quotes).
3. A random forest, trained on labelled findings, gives the probability that it
   is a secret; those below ``THRESHOLD`` are removed as false positives.

Labelled findings are a table ``left, value, right, label``.  The supplied data
hold none, so ``labelled_findings`` makes them: values drawn by kind -- keys, tokens
and passwords for 1; commit digests, UUIDs, card and phone numbers, paths, dated
file names, slugs, placeholders and plain words for 0 -- from a document's hash and
words, set into the document's text.  The label is the kind that was drawn, never
a feature.  ``held_out_figures`` gives precision and recall on kinds that the forest
has not seen.  ``find_secrets`` takes any table of labelled findings instead.

Defined results: null and empty texts have no candidates; a text may have any
number of them; repeated rows are scanned each; null ids are kept; other columns
are ignored (``redact`` keeps them unchanged); with no labelled findings of both
kinds each candidate has probability 0.5 and is taken for a secret; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, hash_share, stored

CONTEXT = 48
THRESHOLD = 0.5
SAMPLE_DOCS = 2000
TREES, DEPTH, SEED = 20, 6, 11
MASK = "[SECRET]"

# Words that announce a secret, and words that announce a harmless value
ANNOUNCES = (r"(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[ _-]?key|access[ _-]?key|private[ _-]?key|auth(?:orization)?|"
             r"bearer|credential|signature)")
HARMLESS = (r"(?:commit|sha(?:1|256)?|md5|hash|checksum|digest|uuid|guid|order|invoice|card|phone|isbn|build|revision|"
            r"version|path|file|url|http|id)")

# What a candidate can be (Java patterns); the groups are what stands before it and, in turn, the value
_RUN = r"[A-Za-z0-9+/_-]"
TOKEN = rf"(?<!{_RUN})(?=[A-Za-z+/_-]*+[0-9]){_RUN}{{16,}}={{0,2}}"
_IN_URL = r"(://[^\s/@:]*+:)([^\s/\"<>`]+)(?=@)"
_SCHEME = r"(?i:bearer|basic|token)[ \t]"
_BEFORE = (rf"((?<!{_RUN}){_RUN}*?" + ANNOUNCES.replace("(?:", "(?i:", 1) + r"[\"'`\]]?[ \t]*+(?::=|=>|==?|:)[ \t]*+"
           rf"(?:{_SCHEME}++[ \t]*+)?+)(?!{_SCHEME})")
_QUOTED = "".join(rf"({q})((?!\s*{q})[^{q}\\\r\n]*+(?:\\.[^{q}\\\r\n]*+)*+)(?={q})|" for q in "\"'`")
_BARE = r"([\"'`]?+)([^\s\"'`<>=:](?:[^\s\"'`<>]*[^\s\"'`<>.,;:)\]}])?)"
CANDIDATE = f"{_IN_URL}|{_BEFORE}(?:{_QUOTED}{_BARE})|({TOKEN})"
_KEPT, _VALUE = "$1$3$4$6$8$10", "$2$5$7$9$11$12"
# marks round a value: the first pair that the text has not
MARKS = [("\x01", "\x02"), ("﷐", "﷑"), ("﷮", "﷯")]

# Words that identifiers, paths and slugs are made of
DICTIONARY = sorted("""
about access account action active address admin after alpha and api app archive array assets author auto back base
batch beta bin block blog body book build button cache call case change check class click client close cloud code col
color com common config connect content copy core count create css data date debug default delete demo design dev dir
doc docs document download edit element email end entry error event example export field file files filter final find
first font for form format from function get global graph group handler head header help home host html http https icon
image images img import index info init input item java job json key lang last layout left level lib line link list load
local log login main manager map master media menu message meta method mobile model module month name nav net new news
node note number object old open option order org out package page params parent part path photo plugin post print
product profile project public query random read record release remote report request resource response result right
root route run sample save schema script search section select server service session set setting simple single site
size source spec src start state static status step store style submit summary system tab table tag target task temp
template test text the theme this thread time title tool top total type update upload url user util value vendor version
video view web week widget window with word work year
""".split())

FEATURES = ["length", "digit", "upper", "lower", "mark", "runs", "digit_letter", "letter_run", "vowel", "variety", "hex",
            "covered", "slash", "dash", "dated", "grouped", "path_before", "path_after", "announced", "harmless",
            "assigned", "quoted", "key_format", "in_url"]


def _count(value: Column, pattern: str) -> Column:
    return F.length(value) - F.length(F.regexp_replace(value, pattern, ""))


def features(value: Column, left: Column, right: Column) -> dict[str, Column]:
    """The columns ``FEATURES`` of a candidate with the text before and after it."""
    n = F.length(value).cast("double")
    kinds = F.translate(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        value, "[0-9]", "\u0001"), "[A-Z]", "\u0002"), "[a-z]", "\u0003"), "\u0001\u0002\u0003", "dul")
    runs = F.length(F.regexp_replace(kinds, r"(.)\1*", "x"))
    letters = F.regexp_extract_all(F.lower(value), F.lit("([a-z]+)"), 1)
    longest = F.coalesce(F.array_max(F.transform(letters, lambda x: F.length(x))), F.lit(0))
    words = F.array(*map(F.lit, DICTIONARY))
    known = F.aggregate(F.filter(letters, lambda x: F.array_contains(words, x)), F.lit(0),
                        lambda a, x: a + F.length(x))
    near = F.lower(F.right(left, F.lit(24)))

    def flag(c: Column) -> Column:
        return c.cast("double")

    out = {
        "length": F.least(n, F.lit(200.0)),
        "digit": _count(value, "[0-9]") / n, "upper": _count(value, "[A-Z]") / n, "lower": _count(value, "[a-z]") / n,
        "mark": _count(value, "[^A-Za-z0-9]") / n, "runs": runs / n,
        "digit_letter": F.size(F.regexp_extract_all(kinds, F.lit("(d(?=[ul])|[ul](?=d))"), 1)) / n,
        "letter_run": F.least(longest, F.lit(40)).cast("double"),
        "vowel": _count(F.lower(value), "[aeiou]") / F.greatest(F.lit(1.0), _count(value, "[A-Za-z]").cast("double")),
        "variety": F.size(F.array_distinct(F.split(value, ""))) / n,
        "hex": flag(value.rlike("^[0-9a-fA-F]+$")), "covered": known / n,
        "slash": _count(value, "/").cast("double"), "dash": _count(value, "[_-]").cast("double"),
        "dated": flag(value.rlike(r"(?:19|20)\d\d[-_/]?[01]\d[-_/]?[0-3]\d")),
        "grouped": flag(value.rlike("^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$")),
        "path_before": flag(left.rlike(r"[/\\.@#~?&:]$")), "path_after": flag(right.rlike(r"^[.@/\\?&%][A-Za-z]")),
        "announced": flag(near.rlike(ANNOUNCES + r"[^a-z]{0,6}$")),
        "harmless": flag(near.rlike(HARMLESS + r"[^a-z]{0,6}$")),
        "assigned": flag(left.rlike(r"[=:]\s*[\"']?$")), "quoted": flag(left.rlike(r"[\"'`]$") & right.rlike(r"^[\"'`]")),
        "key_format": flag(value.rlike(r"^(?:A(?:KIA|SIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-|sk_live_|"
                                       r"AIza[0-9A-Za-z_-]{35}|eyJ[A-Za-z0-9_-]{10})")),
        "in_url": flag(left.rlike(r"(?:://|^)[^\s/@:]*:$") & right.rlike("^@")),
    }
    return {k: F.coalesce(out[k].cast("double"), F.lit(0.0)) for k in FEATURES}


def cut(text: Column) -> Column:
    """The text cut at its candidates: text, candidate, text, ..., text; null if it
    has none.  (A text that holds all of ``MARKS`` loses the first pair.)"""
    def at(pair: tuple[str, str], t: Column) -> Column:
        marked = F.regexp_replace(t, CANDIDATE, f"{_KEPT}{pair[0]}{_VALUE}{pair[1]}")
        return F.when(F.contains(marked, F.lit(pair[0])), F.split(marked, f"[{pair[0]}{pair[1]}]", -1))

    def holds(pair: tuple[str, str]) -> Column:
        return F.contains(text, F.lit(pair[0])) | F.contains(text, F.lit(pair[1]))

    first, second, third = MARKS
    return F.when(~holds(first), at(first, text)).when(~holds(second), at(second, text)).when(
        ~holds(third), at(third, text)).otherwise(at(first, F.translate(text, "".join(first), "  ")))


def candidates(rows: DataFrame, parts: str, keep: list[str]) -> DataFrame:
    """One row per candidate of ``rows[parts]`` (see ``cut``): the columns ``keep``,
    ``nth``, ``value``, ``left``, ``right`` and ``gap``, the characters since the
    candidate before."""
    p = F.col(parts)
    one = F.transform(F.sequence(F.lit(0), F.floor(F.size(p) / 2).cast("int") - 1), lambda i: F.struct(
        i.alias("nth"), F.element_at(p, 2 * i + 2).alias("value"),
        F.right(F.element_at(p, 2 * i + 1), F.lit(CONTEXT)).alias("left"),
        F.left(F.element_at(p, 2 * i + 3), F.lit(CONTEXT)).alias("right"),
        F.length(F.element_at(p, 2 * i + 1)).alias("gap")))
    return rows.where(p.isNotNull()).select(*keep, F.explode(one).alias("c")).select(*keep, "c.*")


def made_findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Findings of known kind, set into the text of about ``n_docs`` documents chosen
    by hash: ``left, value, right, label, kind``."""
    text = F.col(text_col)
    rows = docs.where(F.length(text) > 100).select(F.col(id_col).cast("string").alias("i"), text.alias("t"))
    some = rows.where(hash_share(F.xxhash64("i", "t"), n_docs, rows.count()))
    h = F.sha2(F.concat_ws("|", "i", "t"), 512)

    def part(a: int, n: int) -> Column:
        return F.substring(h, a, n)

    def base64(a: int, n: int) -> Column:
        return F.substring(F.base64(F.unhex(part(a, 64))), 1, n)

    words = F.filter(F.split(F.substring("t", 1, 2000), "[^A-Za-z]+"), lambda x: F.length(x) > 2)
    word = lambda k: F.coalesce(F.get(words, F.lit(k)), F.lit("page"))
    slug = lambda sep: F.lower(F.concat_ws(sep, word(0), word(1), word(2), word(3)))
    pick = F.pmod(F.xxhash64("t"), F.lit(len(DICTIONARY) - 3)) + 1
    term = lambda k: F.element_at(F.array(*map(F.lit, DICTIONARY)), (pick + k).cast("int"))
    digits = F.translate(part(1, 20), "abcdef", "012345")
    date = F.concat(F.lit("20"), F.substring(digits, 1, 2), F.lit("-1"), F.translate(part(3, 1), "3456789abcdef", "0120120120120"),
                    F.lit("-0"), F.translate(part(4, 1), "0abcdef", "1234567"))
    letters = F.translate(base64(21, 26), "0123456789+/=", "qXwZvYkJhGfDs")
    mixed = F.concat(F.initcap(term(0)), F.substring(digits, 5, 2), F.lit("&"), base64(40, 3))
    marked = F.concat(base64(3, 5), F.translate(part(7, 1), "0123456789abcdef", "!$%.~@!$%.~@!$%."), base64(20, 4))
    # candidates by context, of any form
    assigned = [
        (marked, ' password = "', '" ', 1), (marked, " pwd: ", " ", 1), (mixed, ' password="', '" ', 1),
        (mixed, " passwd=", "\n", 1), (part(2, 10), " password: ", " ", 1), (letters, " secret: ", "\n", 1),
        (letters, ' token="', '" ', 1), (base64(11, 9), " postgres://app:", "@db/x ", 1), (marked, " https://user:", "@example.com/ ", 1),
        (mixed, " mysql://root:", "@localhost:3306/ ", 1),
        (term(0), " password: ", " ", 0), (word(0), " token: ", " ", 0), (word(1), " secret = ", " ", 0),
        (F.initcap(word(2)), " Signature: ", " ", 0), (F.concat_ws(".", term(0), term(1)), " token = ", "; ", 0),
        (F.concat(term(0), F.initcap(term(1)), F.lit("(")), " password = ", ") ", 0),
        (F.concat(F.lit("${"), F.upper(term(0))), " password=", "} ", 0), (F.concat_ws(" ", word(0), word(1), word(2)), ' password: "', '" ', 0),
        (F.concat_ws("_", term(0), term(1)), ' auth: "', '" ', 0), (F.lit("********"), " password: ", " ", 0)]
    made = [(*x, True) for x in assigned] + [(*x, False) for x in [
        (part(1, 18), " password=", " ", 1), (part(1, 40), ' token = "', '" ', 1), (base64(1, 32), " secret: ", "\n", 1),
        (base64(9, 40), " aws_secret_access_key = ", "\n", 1), (base64(17, 24), " 'api_key': '", "', ", 1),
        (F.concat(F.lit("AKIA"), F.upper(base64(33, 16))), " ", " ", 1), (part(20, 32), "Authorization: Bearer ", "\n", 1),
        (F.concat(F.lit("ghp_"), F.regexp_replace(base64(5, 36), "[+/=]", "x")), " ", " ", 1),
        (part(41, 40), " commit ", " ", 0), (part(1, 64), " sha256: ", "\n", 0), (part(60, 32), " md5 checksum ", " ", 0),
        (F.concat_ws("-", part(1, 8), part(9, 4), part(13, 4), part(17, 4), part(21, 12)), " id: ", " ", 0),
        (F.concat_ws("-", part(31, 8), part(39, 4), part(43, 4), part(47, 4), part(51, 12)), " ", " ", 0),
        (F.substring(digits, 1, 16), " ", " ", 0), (digits, " order ", ", ", 0), (F.substring(digits, 3, 16), " card: ", " ", 0),
        (F.concat(slug("-"), F.lit("-"), date), "https://example.com/", ".html ", 0),
        (F.concat_ws("/", term(0), term(1), term(2), date), " /", "/index.html ", 0),
        (F.concat(slug("_"), F.lit("_"), F.substring(digits, 1, 3)), " ", " ", 0),
        (F.concat_ws("_", term(0), term(1), date), " file ", ".txt ", 0),
        (F.concat(term(0), F.initcap(term(1)), F.initcap(term(2)), F.lit("Version2")), " ", "( ", 0),
        (F.concat(slug(""), F.lit("1")), " ", " ", 0)]]
    # any place of the document's own text
    start = F.pmod(F.xxhash64("t", F.lit(1)), F.length("t")) + 1
    before = F.regexp_replace(F.substr("t", start.cast("int"), F.lit(CONTEXT)), r"\s\S*$", "")
    after = F.regexp_replace(F.right("t", F.lit(CONTEXT)), r"\S*$", "")
    built = some.select(F.explode(F.array(*[
        F.struct(F.right(F.concat(before, F.lit(a)), F.lit(CONTEXT)).alias("left"), v.alias("value"),
                 F.left(F.concat(F.lit(b), after), F.lit(CONTEXT)).alias("right"), F.lit(y).alias("label"),
                 F.lit(k).alias("kind"), F.lit(c).alias("c"))
        for k, (v, a, b, y, c) in enumerate(made)])).alias("m")).select("m.*")
    return built.where(F.col("c") | F.col("value").rlike(f"^(?:{TOKEN})$")).drop("c")


def labelled_findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      n_docs: int = SAMPLE_DOCS) -> DataFrame:
    """A bounded sample of labelled findings, ``left, value, right, label``: about 42
    of each of about ``n_docs`` documents."""
    return made_findings(docs, id_col, text_col, n_docs).select("left", "value", "right", "label")


def held_out_figures(docs: DataFrame, folds: int = 5, n_docs: int = SAMPLE_DOCS) -> tuple[float, float]:
    """(precision, recall) over kinds of findings that were held out of training, fold by fold."""
    made = stored(made_findings(docs, n_docs=n_docs), "made")
    hit = secret = flagged = 0
    for f in range(folds):
        out = F.col("kind") % folds == f
        model = train(made.where(~out))
        got = judge(made.where(out), model).agg(
            F.sum(F.col("label")).alias("s"), F.count_if(F.col("probability") >= THRESHOLD).alias("f"),
            F.count_if((F.col("probability") >= THRESHOLD) & (F.col("label") == 1)).alias("h")).first()
        hit, secret, flagged = hit + got.h, secret + got.s, flagged + got.f
    return hit / flagged, hit / secret


def _vectors(found: DataFrame) -> DataFrame:
    f = features(F.col("value"), F.col("left"), F.col("right"))
    named = found.withColumns({f"_f_{k}": c for k, c in f.items()})
    made = VectorAssembler(inputCols=[f"_f_{k}" for k in FEATURES], outputCol="_vector").transform(named)
    return made.drop(*(f"_f_{k}" for k in FEATURES))


def train(findings: DataFrame):
    """A forest from labelled findings; None without findings of both kinds."""
    rows = stored(findings.where("left is not null and value is not null and right is not null")
                  .select("left", "value", "right", F.col("label").cast("double").alias("label"))
                  .repartition(4, F.xxhash64("value", "left", "right")).sortWithinPartitions("value", "left", "right"),
                  "findings")
    if rows.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(featuresCol="_vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED,
                                    probabilityCol="_probability", rawPredictionCol="_raw", predictionCol="_class")
    return forest.fit(_vectors(rows))


def judge(found: DataFrame, model) -> DataFrame:
    """``found`` (candidates) with ``probability`` of being a secret."""
    if model is None:
        return found.withColumn("probability", F.lit(0.5))
    scored = model.transform(_vectors(found))
    return scored.withColumn("probability", F.element_at(vector_to_array("_probability"), 2)).drop(
        "_vector", "_raw", "_probability", "_class")


def find_secrets(docs: DataFrame, findings: DataFrame | None = None, threshold: float = THRESHOLD,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per candidate: ``doc_id, start`` (code points before it), ``value``,
    ``probability`` and ``is_secret``."""
    model = train(findings if findings is not None else labelled_findings(docs, id_col, text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                       cut(F.col(text_col)).alias("parts"))
    found = candidates(rows, "parts", ["doc_id", "row"])
    # the start of each candidate is a running sum over those before it
    before = Window.partitionBy("row").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)
    upto = F.coalesce(F.sum(F.col("gap") + F.length("value")).over(before), F.lit(0)) + F.col("gap")
    found = found.withColumn("start", upto.cast("long")).drop("row", "gap", "nth")
    return judge(found, model).select(
        "doc_id", "start", "value", "probability", (F.col("probability") >= threshold).alias("is_secret"))


def redact(docs: DataFrame, findings: DataFrame | None = None, threshold: float = THRESHOLD, mask: str = MASK,
           id_col: str = "doc_id", text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with each secret in the text replaced by ``mask`` and ``size_col``,
    if it is there, set to the new length; other rows and columns unchanged."""
    model = train(findings if findings is not None else labelled_findings(docs, id_col, text_col))
    row, parts = free_name(docs.columns, "row"), free_name([*docs.columns, "row"], "parts")
    flags, rid = free_name([*docs.columns, row, parts], "flags"), free_name([*docs.columns, row, parts], "rid")
    rows = stored(docs.withColumn(parts, cut(F.col(text_col))).withColumn(row, F.monotonically_increasing_id()),
                  "cut-at-candidates")
    judged = judge(candidates(rows, parts, [row]), model)
    # a row's candidates only: true at the places of secrets
    secret = judged.groupBy(F.col(row).alias(rid)).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("nth", (F.col("probability") >= threshold).alias("s")))),
        lambda x: x["s"]).alias(flags)).where(F.exists(flags, lambda x: x))
    some = rows.where(F.col(parts).isNotNull()).join(secret, F.col(row) == F.col(rid), "left")
    masked = F.array_join(F.transform(parts, lambda p, i: F.when(
        (i % 2 == 1) & F.element_at(F.col(flags), F.floor(i / 2).cast("int") + 1), F.lit(mask)).otherwise(p)), "")
    out = some.withColumn(flags, F.when(F.col(rid).isNotNull(), masked).otherwise(F.col(text_col)))
    columns = []
    for c in docs.columns:
        if c == text_col:
            columns.append(F.col(flags).alias(c))
        elif size_col is not None and c == size_col:
            columns.append(F.when(F.col(rid).isNull(), F.col(f"`{c}`")).otherwise(
                F.length(flags)).cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col(f"`{c}`"))
    return rows.where(F.col(parts).isNull()).select(*(F.col(f"`{c}`") for c in docs.columns)).unionByName(
        out.select(*columns))
