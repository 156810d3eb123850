"""Secret scans: candidates by shape, false positives removed by a random forest (DataFrame and MLlib
code on the JVM only).

Candidates are words with a run of 16 or more key characters and a digit, and words of six or more
characters assigned to a telling name (``password = ...``). Each gets the features of the method: length,
character classes and the transitions between them, entropy, dictionary coverage (letter runs that are
frequent words of the corpus, counted over all documents), path shape, and the neighbouring words
(telling name, assignment, words that announce a digest or an example). A forest trained on labelled findings
gives the probability that the candidate is a secret; a finding is one at ``THRESHOLD`` or more.

Labelled findings are made by rule (``labelled_findings``): keys (Base64 with and without padding), tokens and passwords of
common formats in telling contexts, and digests, identifiers, paths, numbers, dates, placeholders and mail addresses in theirs.

Only candidates leave the scan. Letter runs of candidates meet the words of the corpus in a join that
keeps just those runs, so the word counts that are shuffled are few. ``redacted`` replaces the
secrets in the texts.

Edge cases: null and empty texts have no candidates; a null id is reported as null; equal rows are
scanned once each and report the same findings; ties do not matter (no ranking); an empty table gives no
findings; other columns are ignored by the scan and kept by ``redacted``.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from traitflow.llm import common as C

THRESHOLD = 0.5
EXAMPLES = 6_000          # labelled findings made for the training
TREES, DEPTH, SEED = 40, 8, 11
FREQUENT = 20             # occurrences that make a letter run a dictionary word
MASK = "[SECRET]"

NAMES = r"(?i)(?:token|secret|passw|passphrase|pwd|api[_-]?key|apikey|access[_-]?key|auth|bearer|credential|private[_-]?key|client[_-]?key)"
OTHERS = r"(?i)(?:commit|sha\d*|md5|checksum|digest|hash|etag|uuid|guid|revision|build|version|example|sample|dummy|isbn|order|invoice|ticket|card|phone)"
LONG = r"[A-Za-z0-9+/_=-]{16}"
# a name and its sign before a value of six characters or more; the = at the end of a Base64 key is no sign
ASSIGNED = r"""^["']?[A-Za-z_][A-Za-z0-9_.-]*["']?(?:=|:(?!//))+(?!=)(?!["'][,;)}\]])(?=(?:["'=]*[^"'=]){6})"""


def value_of(word: Column) -> Column:
    """The word without an assigned name before it and quotes or punctuation around it."""
    bare = F.regexp_replace(word, ASSIGNED, "")
    return F.regexp_replace(F.regexp_replace(bare, r"""^["'`(\[{<]+""", ""), r"""["'`)\]}>,;.:!?#%&*$|]+$""", "")


def candidates(text: Column) -> Column:
    """array<struct<place, word, one, two, next>> of the words of a text that may hold a secret; place is the number of
    the word, one and two the words before it."""
    def at(w, i):
        return F.when((i >= 0) & (i < F.size(w)), w[F.greatest(F.least(i, F.size(w) - 1), F.lit(0))]).otherwise(F.lit(""))

    def wanted(w, x, i):
        shaped = (F.length(x) >= 16) & x.rlike("[0-9]") & x.rlike(LONG)
        given = (F.length(x) >= 6) & (i > 0) & at(w, i - 1).rlike("[=:]$") & (at(w, i - 1).rlike(NAMES) | at(w, i - 2).rlike(NAMES))
        inside = (F.length(x) >= 10) & ((F.instr(x, "=") > 0) | (F.instr(x, ":") > 0)) & x.rlike(NAMES + r"""["']?[=:]+["']?[^"'\s=:]{6}""")
        return shaped | given | inside

    def of(w):
        marked = F.transform(w, lambda x, i: F.when(wanted(w, x, i), F.struct(
            i.cast("long").alias("place"), x.alias("word"), at(w, i - 1).alias("one"), at(w, i - 2).alias("two"), at(w, i + 1).alias("next"))))
        return F.filter(marked, lambda s: s.isNotNull())

    return C.let(C.words(text), of)


def found(docs: DataFrame, key: Column, *more: str) -> DataFrame:
    """key, place, word, one, two, next, value: one row per candidate."""
    rows = docs.select(key.alias("key"), *more, F.explode(candidates(F.col("text"))).alias("c")).select("key", *more, "c.*")
    return rows.withColumn("value", value_of(F.col("word"))).filter(F.length("value") >= 6)


def letter_runs(value: Column) -> Column:
    return F.filter(F.split(F.lower(value), "[^a-z]+"), lambda r: F.length(r) >= 3)


def dictionary(docs: DataFrame, runs: DataFrame) -> DataFrame:
    """The rows of ``runs`` (run) that are words of the corpus FREQUENT times or more."""
    plain = F.filter(C.words(F.lower(F.col("text"))), lambda w: (F.length(w) >= 3) & (F.length(w) <= 24))
    words = docs.select(F.explode(plain).alias("w")).select(F.regexp_replace("w", r"[.,;:!?]+$", "").alias("w"))
    return words.join(runs, F.col("w") == F.col("run"), "left_semi").groupBy("w").count().filter(F.col("count") >= FREQUENT).select("w")


def features(rows: DataFrame) -> tuple[DataFrame, list[str]]:
    """``rows`` (value, one, two, next, word, covered) with one numeric column per feature."""
    v, n = F.col("value"), F.length("value")
    share = lambda chars: F.length(F.regexp_replace(v, f"[^{chars}]", "")) / n
    kinds = F.split(F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "[^A-Za-z0-9]", "-"), "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0"), "")
    changes = C.let(F.filter(kinds, lambda k: k != ""), lambda k: F.aggregate(
        F.zip_with(F.slice(k, 1, F.size(k) - 1), F.slice(k, 2, F.size(k) - 1), lambda a, b: (a != b).cast("double")), F.lit(0.0), lambda s, x: s + x))
    chars = F.filter(F.split(v, ""), lambda c: c != "")
    entropy = C.let(chars, lambda cs: F.aggregate(F.transform(F.array_distinct(cs), lambda d: F.size(F.filter(cs, lambda c: c == d)) / F.size(cs)),
                                                 F.lit(0.0), lambda s, p: s - p * F.log2(p)))
    before = F.concat_ws(" ", "two", "one")
    flag = lambda c: c.cast("double")
    built = {
        "f_length": n.cast("double"), "f_lower": share("a-z"), "f_upper": share("A-Z"), "f_digit": share("0-9"), "f_other": 1 - share("A-Za-z0-9"),
        "f_changes": changes / n, "f_entropy": entropy, "f_hex": flag(v.rlike("^[0-9a-fA-F]+$")), "f_vowels": share("aeiouAEIOU"), "f_covered": F.col("covered") / n,
        "f_slashes": (n - F.length(F.translate(v, "/\\", ""))).cast("double"), "f_dots": (n - F.length(F.translate(v, ".", ""))).cast("double"),
        "f_dashes": (n - F.length(F.translate(v, "-", ""))).cast("double"), "f_mail": flag(v.rlike("@|://")), "f_uuid": flag(v.rlike("(?i)[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}")),
        "f_name": flag(before.rlike(NAMES) | F.col("word").rlike(NAMES)), "f_assign": flag(F.col("one").rlike("[=:]$") | F.col("word").rlike(ASSIGNED)),
        "f_quoted": flag(F.col("word").rlike("[\"']")), "f_announced": flag(before.rlike(OTHERS) | F.col("next").rlike(OTHERS) | v.rlike("(?i)example|sample|dummy|your|xxxx|placeholder|changeme")),
        "f_known": flag(v.rlike("^(?:AKIA|ASIA|AIza|gh[pousr]_|github_pat_|sk[-_]|rk_|pk_live|xox[abpors]-|eyJ|glpat-|npm_|hf_|SG\\.)")),
    }
    return rows.withColumns(built), list(built)


def labelled_findings(spark: SparkSession, examples: int = EXAMPLES) -> DataFrame:
    """label, text: short texts with one finding each, made by rule from hashes of row numbers.

    The parts that several texts use are columns of a projection of their own: in one expression each use would be a
    copy of its tree, which the driver would plan, print and compile."""
    i = F.col("id")
    h = lambda salt: F.sha2(F.concat(i.cast("string"), F.lit(salt)).cast("binary"), 256)
    padded = lambda salt, k: F.base64(F.unhex(F.substring(h(salt), 1, k)))
    b64 = lambda salt: F.translate(padded(salt, 64), "=", "")
    alnum = lambda salt: F.translate(b64(salt), "+/", "xQ")
    pick = lambda salt, *of: F.element_at(F.array(*[F.lit(x) if isinstance(x, str) else x for x in of]), (F.pmod(F.xxhash64(i, F.lit(salt)), F.lit(len(of))) + 1).cast("int"))
    digits = lambda salt, k: F.substring(F.translate(h(salt), "abcdef", "123456"), 1, k)
    uuid = F.concat_ws("-", F.substring(h("u"), 1, 8), F.substring(h("u"), 9, 4), F.substring(h("u"), 13, 4), F.substring(h("u"), 17, 4), F.substring(h("u"), 21, 12))
    word = lambda salt: pick(salt, "the", "of", "value", "here", "item", "was", "see", "page", "it", "then", "report", "for", "data", "with")
    key = pick("k", pick("s1", F.substring(h("a"), 1, 40), F.substring(h("a"), 1, 32), h("a")), F.concat(F.lit("AKIA"), F.upper(F.substring(F.translate(h("b"), "0189", "GHJK"), 1, 16))),
               F.concat(F.lit("ghp_"), F.substring(alnum("c"), 1, 36)), F.concat(pick("s2", "sk_live_", "sk-", "rk_", "hf_", "glpat-"), F.substring(alnum("d"), 1, 24)),
               F.concat(F.lit("xoxb-"), digits("e", 12), F.lit("-"), F.substring(alnum("f"), 1, 24)), F.concat(F.lit("eyJ"), F.substring(alnum("g"), 1, 33), F.lit("."), alnum("h")),
               b64("i"), pick("s5", padded("P", 32), padded("P", 40), padded("P", 64)), F.concat(pick("s3", "Sommer", "hunter", "Blue!", "qwe", "Pa55"), digits("j", 4), pick("s4", "!", "$x", "#A", "zz", "Kp")), F.concat(F.lit("AIza"), F.substring(alnum("l"), 1, 35)))
    name = pick("n", "token", "secret", "password", "api_key", "API_KEY", "access_key", "auth_token", "passwd", "client_secret", "apikey")
    q = pick("q", "\"", "'", "\"", "")
    parts = spark.range(0, examples, 1, 1).select("id", key.alias("p_key"), name.alias("p_name"), q.alias("p_quote"), uuid.alias("p_uuid"), h("m").alias("p_hash"))
    key, name, q, uuid, hashed = (F.col(c) for c in ("p_key", "p_name", "p_quote", "p_uuid", "p_hash"))
    secret = pick("w", F.concat(name, F.lit(" = "), q, key, q), F.concat(name, F.lit(" = "), q, key, q), F.concat(name, F.lit(": "), q, key, q), F.concat(name, F.lit("="), q, key, q), F.concat(F.lit("Bearer "), key))
    harmless = pick("x", F.concat(F.lit("commit "), F.substring(hashed, 1, 40)), F.concat(pick("y", "md5 ", "sha256 ", "checksum: ", "digest = "), pick("y2", F.substring(hashed, 1, 32), hashed, padded("m", 64))),
                    F.concat(F.lit("/files/"), uuid, pick("y3", ".html", ".png", "/index")), F.concat(F.lit("uuid: "), uuid), digits("o", 16), F.concat(F.lit("https://example.com/"), word("p"), F.lit("/"), digits("p", 8), F.lit("?page=2&ref=x")),
                    F.concat(word("r"), F.lit("."), digits("r", 2), F.lit("@mail"), digits("s", 1), F.lit(".example.com")), F.concat(F.lit("2024-05-"), digits("t", 2), F.lit("T10:"), digits("v", 2), F.lit(":00.000Z")),
                    F.concat(F.lit("IMG_"), digits("z", 8), F.lit("_123456.jpg")), F.concat(name, F.lit(" = \""), pick("y4", "your_api_key_here_1", "xxxxxxxxxxxxxxxx1", "EXAMPLE_KEY_12345678", "changeme1", "0000000000000000", "placeholder_123456"), F.lit("\"")),
                    F.concat(F.lit("section"), digits("A", 2), F.lit("-paragraph"), digits("A", 2), F.lit("-overview")), F.concat(F.lit("order "), digits("B", 18)), F.concat(F.lit("lib/python3.11/site-packages/"), word("B"), F.lit("_"), digits("C", 3), F.lit("/core.py")))
    label = F.pmod(F.xxhash64(i, F.lit("label")), F.lit(2)).cast("int")
    return parts.select("id", label.alias("label"), F.concat_ws(" ", word("L1"), word("L2"), F.when(label == 1, secret).otherwise(harmless), word("R1"), word("R2")).alias("text"))


def covered(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``rows`` with ``covered``, the letters of ``value`` that lie in dictionary runs. The distinct values meet the dictionary."""
    runs = rows.select("value").distinct().select("value", F.explode(F.array_distinct(letter_runs(F.col("value")))).alias("r"))
    sums = runs.join(known, F.col("r") == F.col("w")).groupBy(F.col("value").alias("v")).agg(F.sum(F.length("r")).alias("covered"))
    return rows.join(sums, F.col("value") == F.col("v"), "left").withColumn("covered", F.least(F.coalesce("covered", F.lit(0)), F.length("value")).cast("double")).drop("v")


def forest(examples: DataFrame):
    """Random forest on labelled candidates (label, and what ``features`` reads). The vectors are written first: each of
    the forest's jobs sends the lineage of its rows to the tasks, which is then a scan and not the plan of the features."""
    rows, names = features(examples)
    vectors = VectorAssembler(inputCols=names, outputCol="x").transform(rows).select("label", "x").coalesce(1)
    data = C.written(vectors, "secret-vectors").coalesce(1)
    return RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED).fit(data)


def judged(docs: DataFrame, key: Column) -> DataFrame:
    """key, place, value, probability, is_secret: every candidate of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    marks = found(labelled_findings(spark), F.col("id"), "label").select("key", "label", "place", "word", "one", "two", "next", "value")
    marks = C.written(marks, "secret-examples")
    mine = C.written(found(docs, key), "secret-candidates")
    both = mine.select("value").union(marks.select("value")).distinct()
    runs = both.select(F.explode(letter_runs(F.col("value"))).alias("run")).distinct()
    known = C.written(dictionary(docs, C.written(runs, "secret-runs")), "secret-words")
    model = forest(covered(marks, known))
    rows, names = features(covered(mine, known))
    scored = model.transform(VectorAssembler(inputCols=names, outputCol="x").transform(rows))
    chance = vector_to_array("probability")[1]
    return scored.select("key", "place", "value", chance.alias("probability"), (chance >= THRESHOLD).alias("is_secret"))


def redacted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with their columns, secrets in the text replaced by ``MASK``; n_chars (if there)
    follows the new text."""
    hits = judged(docs.select("doc_id", "text"), C.row_key()).filter("is_secret")
    secrets = C.written(hits.groupBy(F.col("key").alias("_k")).agg(F.collect_set("value").alias("_secrets")), "secret-hits")
    row = F.struct(*[F.col(c) for c in docs.columns])
    joined = docs.select(row.alias("_row"), C.row_key().alias("_key")).join(secrets, F.col("_key").eqNullSafe(F.col("_k")), "left")
    # longer secrets first: one may be part of another
    order = F.array_sort(F.col("_secrets"), lambda a, b: F.when(F.length(a) > F.length(b), -1).when(F.length(a) < F.length(b), 1).when(a < b, -1).when(a > b, 1).otherwise(0))
    clean = F.when(F.col("_secrets").isNull(), F.col("_row.text")).otherwise(F.aggregate(order, F.col("_row.text"), lambda t, s: F.replace(t, s, F.lit(MASK))))
    out = joined.select("_row.*", clean.alias("_clean"), F.col("_secrets").isNotNull().alias("_hit"))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("_clean").alias("text"))
        elif c == "n_chars":
            columns.append(F.when(F.col("_hit"), F.length("_clean").cast(docs.schema[c].dataType)).otherwise(F.col(c)).alias(c))
        else:
            columns.append(F.col(c))
    return out.select(*columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = judged(C.table(spark, sf_dir, "documents").select("doc_id", "text"), C.row_key())
    return out.select(F.col("key.id").alias("doc_id"), "place", F.col("value").alias("finding"), "probability", "is_secret")
