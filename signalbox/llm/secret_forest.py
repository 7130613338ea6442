"""Secret scan: regular-expression candidates, false positives removed by a random forest.

Candidates are runs of key-like characters that hold a digit, runs with a known
key opening, private key blocks, and whatever is assigned to a secret word or
stands as the password of an address. Their features are DataFrame expressions: length, character classes and transitions, common
letter pairs, dictionary coverage, path signs and the neighbouring words. The
forest is fitted on labelled findings and applied in the JVM, so no step of
the scan leaves the DataFrame engine. Texts are read once; only rows with a
candidate are taken apart and only candidates are shuffled (for their
positions).
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signalbox.llm.common import col, landed, sized_broadcast, unused_name

LEFT_CHARS, RIGHT_CHARS = 48, 24
SHORTEST = 4  # characters of the shortest candidate
TRAINING_ROWS = 4000  # bound of the labelled sample
THRESHOLD = 0.5
SECRET_MARK = "[SECRET]"
# Words beside secrets and beside look-alikes, common words, letter pairs and
# known key openings: fixed values.
SECRET_WORDS = "access|api|auth|bearer|credential|key|passphrase|passwd|password|private|pwd|secret|token"
HARMLESS_WORDS = ("build|card|checksum|commit|digest|example|fingerprint|hash|id|image|md5|number|order|page|phone|"
                  "release|rev|revision|sha|sha1|sha256|uuid|version")
DICTIONARY = ("about|after|and|article|asset|build|code|customer|data|date|file|for|from|image|item|line|list|main|"
              "name|news|order|page|part|post|product|release|report|review|static|test|the|this|time|total|type|"
              "update|user|version|view|with|world|year")
LETTER_PAIRS = "al|an|ar|as|at|en|er|es|ha|he|in|is|it|le|nd|ne|ng|nt|on|or|ou|re|se|st|te|th|ti|to|ve"
KEY_OPENINGS = "AKIA|ASIA|AIza|gh[opsu]_|github_pat_|glpat-|sk_live_|xox[abpr]-"
PLAIN_WORDS = ("required|understanding|between|something|following|students|important|disabled|information|available|"
               "Authentication|National|Conference|Management|University|development|experience|necessary|nothing|people")
# A candidate by itself: a key block, at least 16 characters of keys with a
# digit among them, or a known opening with as many characters as its keys
# have. A run is taken whole; the look-behind starts it at its first character.
KEY_BLOCK = ("-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----[^-]*+(?:-(?!----)[^-]*+){0,64}+"
             "-----END [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----")
CANDIDATE = (
    f"{KEY_BLOCK}|(?<![A-Za-z0-9+/_-])(?:(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{{16,}}+"
    "|A(?:KI|SI)A[A-Z0-9]{16}+(?![A-Za-z0-9+/_-])|AIza[A-Za-z0-9_-]{30,}+|gh[opsu]_[A-Za-z0-9]{30,}+"
    "|github_pat_[A-Za-z0-9_]{20,}+|glpat-[A-Za-z0-9_-]{16,}+|sk_live_[A-Za-z0-9]{16,}+|xox[abpr]-[A-Za-z0-9-]{12,}+)"
)
# A candidate by its place: six or more printable characters assigned to a
# secret word, or the password of an address. The short look-behinds come
# first, as they fail almost everywhere.
ASSIGNED = (
    "(?<=[=:> \\t\"'])(?:(?<=[=:>][ \\t]{0,3}[\"']?)"
    f"(?<=(?i:{SECRET_WORDS})(?i:s|[0-9]{{1,3}}|[_-][a-z0-9_-]{{1,16}})?[\"'\\]]?[ \\t]{{0,3}}(?:=>|:=|[=:])[ \\t]{{0,3}}[\"']?)"
    "(?:(?<=\")[^\\s\"]{6,}+(?=\")|(?<=')[^\\s']{6,}+(?=')|[^\\s\"'<>]{6,}(?<![.,;:)\\]}]))"
    "|(?<=://[^\\s/:@]{0,64}:)[^\\s/@]{4,}+(?=@))"
)


def _share(count: Column) -> Column:
    return count / F.greatest(F.length("value"), F.lit(1))


def _count(pattern: str, of: str | Column = "value") -> Column:
    return F.regexp_count(F.col(of) if isinstance(of, str) else of, F.lit(pattern)).cast("double")


FEATURES = {
    "length": lambda: F.least(F.length("value"), F.lit(1000)).cast("double"),
    "digits": lambda: _share(_count("[0-9]")),
    "uppers": lambda: _share(_count("[A-Z]")),
    "signs": lambda: _share(_count("[+/_-]")),
    "hex_only": lambda: F.col("value").rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double"),
    "digits_only": lambda: F.col("value").rlike("^[0-9]+$").cast("double"),
    "transitions": lambda: _share(_count("(?<=[a-z])(?=[^a-z])|(?<=[A-Z])(?=[^A-Z])|(?<=[0-9])(?=[^0-9])")),
    "letter_pairs": lambda: _share(_count(f"(?=({LETTER_PAIRS}))", F.lower("value"))),
    "distinct": lambda: F.size(F.array_distinct(F.split("value", ""))).cast("double"),
    "dictionary": lambda: _share(
        F.length("value") - F.length(F.regexp_replace(F.lower("value"), f"({DICTIONARY})", ""))
    ).cast("double"),
    "opening": lambda: F.col("value").rlike(f"^({KEY_OPENINGS})").cast("double"),
    "key_block": lambda: F.col("value").startswith("-----BEGIN ").cast("double"),
    "other_signs": lambda: _share(_count("[^A-Za-z0-9+/_-]")),
    "placeholder": lambda: F.lower("value").rlike(
        f"^[^a-z0-9]|[(\\[{{]|^(your|my|the|some)[_-]|^[a-z]+://|^(.)\\2+$|^({SECRET_WORDS})[0-9]{{0,3}}$|^[a-z_]+[.][a-z_.]+$"
    ).cast("double"),
    "has_value": lambda: F.col("after").rlike("^[\"']?\\s{0,3}(=>|:=|[=:])\\s{0,3}[\"']?[^\\s\"'=]").cast("double"),
    "address_login": lambda: (F.col("before").rlike("://[^\\s/:@]*:$") & F.col("after").startswith("@")).cast("double"),
    "uuid": lambda: F.col("value").rlike("^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$").cast("double"),
    "path": lambda: (_count("/") + F.col("before").rlike("[/.]$").cast("int")
                     + F.col("after").rlike("^[.][a-z]{2,4}\\b").cast("int")).cast("double"),
    "assigned": lambda: F.col("before").rlike("[=:]\\s*[\"']?$").cast("double"),
    "quoted": lambda: (F.col("before").rlike("[\"']$") & F.col("after").rlike("^[\"']")).cast("double"),
    "secret_word": lambda: F.lower("before").rlike(f"(^|[^a-z])[a-z_-]*({SECRET_WORDS})[a-z_-]*[\\s=:\"']*$").cast("double"),
    "harmless_word": lambda: F.lower("before").rlike(f"(^|[^a-z])({HARMLESS_WORDS})[\\s=:#\"']*$").cast("double"),
}


def with_features(findings: DataFrame) -> DataFrame:
    """``findings`` (value, before, after) with one vector column ``features``."""
    names = [f"f_{n}" for n in FEATURES]
    wide = findings.select("*", *[make().alias(n) for n, make in zip(names, FEATURES.values(), strict=True)])
    return VectorAssembler(inputCols=names, outputCol="features").transform(wide).drop(*names)


def labelled_findings(spark: SparkSession, rows: int = TRAINING_ROWS, seed: int = 10) -> DataFrame:
    """Labelled findings (value, before, after, label) for fitting, made from a seed.

    Half are keys in the settings where keys occur, half the look-alikes that
    scanners report: digests, identifiers, slugs, paths, long numbers. At
    most ``rows`` rows, all in one partition, so fits agree. The words and
    digests they are put together from are written first, which keeps the
    plan and its generated code small.
    """
    parts: dict[str, Column] = {}

    def kept(name: str, value: Column) -> Column:
        parts[name] = value
        return F.col(name)

    ident = F.concat(F.lit(f"{seed}:"), F.col("id").cast("string"))
    digest = F.sha2(ident, 256)
    sha, md5 = kept("sha", digest), kept("md5", F.md5(ident))
    dense = kept("dense", F.regexp_replace(F.base64(F.unhex(digest)), "[^A-Za-z0-9]", "x"))
    upper = F.translate(F.upper(F.substring(sha, 1, 32)), "01", "XQ")

    def part(first: int, n: int) -> Column:
        return F.substring(sha, first, n)

    def pick(words: str, salt: int) -> Column:
        options = words.split("|")
        return kept(f"word{salt}", F.element_at(
            F.array(*[F.lit(w) for w in options]), (F.pmod(F.xxhash64("id", F.lit(seed + salt)), F.lit(len(options))) + 1).cast("int")
        ))

    word, lead = pick(DICTIONARY, 1), F.concat(pick(DICTIONARY, 2), F.lit(" "), pick(DICTIONARY, 3), F.lit(" "))
    secret = pick(SECRET_WORDS, 4)
    sign = pick("=| = |: |=\"| = \"|: \"|: '|='", 5)
    close = F.when(sign.contains('"'), F.lit('"')).when(sign.contains("'"), F.lit("'")).otherwise(F.lit(""))
    end = F.concat(close, pick("| |\n|. |, ", 6))
    named = F.concat(lead, secret, sign)
    plain, none = F.concat(lead, word, F.lit(" ")), F.lit(" ")
    harmless = F.concat(lead, pick(HARMLESS_WORDS, 7), pick(" |: |=|#", 8))
    digits = kept("digits", F.substring(F.regexp_replace(F.concat(digest, F.sha2(digest, 256)), "[a-f]", ""), 1, 16))
    uuid = F.concat_ws("-", F.substring(md5, 1, 8), F.substring(md5, 9, 4), F.substring(md5, 13, 4), F.substring(md5, 17, 4), F.substring(md5, 21, 12))
    common = pick(PLAIN_WORDS, 16)
    login = F.concat(lead, pick("postgres|mysql|https|redis|amqp|ftp", 17), F.lit("://"), word, F.lit(":"))
    host, sign_in = F.lit("@db.example.com/"), pick("!|&|#|$|%|*|@|?", 18)
    loose = F.concat(F.substring(dense, 1, 6), sign_in, F.substring(dense, 7, 2), pick("!|#|.|&|~|=", 19), F.substring(dense, 9, 6))
    human = F.concat(F.initcap(pick(DICTIONARY, 20)), F.substring(digits, 1, 4), sign_in)
    leet = F.concat(F.translate(pick(PLAIN_WORDS, 21), "aeost", "43057"), F.substring(digits, 1, 2))
    letters = F.translate(F.upper(F.substring(sha, 1, 24)), "0123456789", "GHJKLMNPQZ")
    block = F.concat(F.lit("-----BEGIN RSA PRIVATE KEY-----\n"), dense, F.lit("\n"), sha, F.lit("\n-----END RSA PRIVATE KEY-----"))
    no_digit = F.translate(upper, "0123456789", "GHJKLMNPQR")
    title = F.concat_ws("_", pick("S3|OAUTH2|V2|DB1|APP_V3|SHA256", 22), F.upper(word), F.upper(secret), F.lit("KEY"))
    value = F.concat(pick("=| = |: |=\"", 23), part(1, 12))
    slug = F.concat_ws("-", word, pick(DICTIONARY, 9), pick(DICTIONARY, 10), F.substring(digits, 1, 4))
    name = F.concat_ws("_", pick(DICTIONARY, 11), word, pick(DICTIONARY, 12), F.substring(digits, 1, 2), pick(DICTIONARY, 13))
    route = F.concat(F.lit("/"), word, F.lit("/"), pick(DICTIONARY, 14), F.lit("/"), F.substring(digits, 1, 6), F.lit("/"), pick(DICTIONARY, 15))
    cases = [  # value, before, after, label
        (part(1, 40), named, end, 1), (part(1, 18), named, end, 1), (part(5, 32), named, end, 1),
        (F.substring(dense, 1, 24), named, end, 1), (F.substring(dense, 1, 40), named, end, 1),
        (F.concat(F.lit("AKIA"), F.substring(upper, 1, 16)), plain, none, 1),
        (F.concat(F.lit("AKIA"), F.substring(upper, 1, 16)), named, end, 1),
        (F.concat(F.lit("ghp_"), F.substring(dense, 1, 36)), plain, none, 1),
        (F.concat(F.lit("AKIA"), F.substring(no_digit, 1, 16)), plain, none, 1),
        (F.concat(F.lit("AKIA"), F.substring(no_digit, 1, 16)), named, end, 1),
        (letters, named, end, 1), (F.lower(letters), named, end, 1), (loose, named, end, 1), (human, named, end, 1),
        (leet, named, end, 1), (F.substring(dense, 1, 10), named, end, 1),
        (loose, login, host, 1), (leet, login, host, 1), (human, login, host, 1), (F.substring(dense, 1, 10), login, host, 1),
        (block, plain, F.lit("\n"), 1), (block, named, end, 1),
        (part(1, 40), harmless, none, 0), (sha, harmless, none, 0), (md5, harmless, none, 0),
        (uuid, plain, none, 0), (uuid, harmless, none, 0), (digits, plain, none, 0), (digits, harmless, none, 0),
        (slug, plain, none, 0), (name, plain, none, 0), (name, named, none, 0), (route, plain, F.lit(".html "), 0),
        (part(1, 20), F.concat(plain, F.lit("static/")), F.lit(".js "), 0), (digits, F.concat(lead, F.lit("+")), none, 0),
        (common, named, end, 0), (F.concat(common, F.lit(","), word), named, end, 0),
        (F.concat_ws("-", word, common), named, end, 0), (F.concat_ws("_", word, common), named, end, 0),
        (F.concat_ws(".", word, common), named, end, 0), (F.concat(word, F.lit("/"), common), named, end, 0),
        (F.concat(F.lit("your_"), secret, F.lit("_here")), named, end, 0), (F.upper(common), named, end, 0),
        (F.concat(F.lit("${"), F.upper(secret), F.lit("}")), named, end, 0),
        (F.concat(F.lit("get_"), secret, F.lit("("), word, F.lit(")")), named, end, 0),
        (F.concat(F.lit("https://"), word, F.lit(".example.com/"), common), named, end, 0),
        (title, plain, value, 0), (F.lower(title), F.concat(lead, F.lit("\n")), value, 0), (F.lit("********"), named, end, 0), (F.lit("password"), login, host, 0),
        (F.lit("password"), named, end, 0),
    ]
    ones, zeros = [c for c in cases if c[3]], [c for c in cases if not c[3]]
    n = F.floor(F.col("id") / 2)
    label = (F.col("id") % 2).cast("double")

    def choose(i: int) -> Column:
        def of(options: list) -> Column:
            out = F.when(n % len(options) == 0, options[0][i])
            for k, c in enumerate(options[1:], 1):
                out = out.when(n % len(options) == k, c[i])
            return out

        return F.when(label == 1, of(ones)).otherwise(of(zeros))

    made = landed(spark.range(0, rows, 1, 1).select("id", *[c.alias(k) for k, c in parts.items()]), "labelled-parts")
    return made.coalesce(1).select(
        choose(0).alias("value"), choose(1).alias("before"), choose(2).alias("after"), label.alias("label")
    )


def fit_forest(labelled: DataFrame, trees: int = 24, depth: int = 8, seed: int = 10) -> RandomForestClassificationModel:
    """A random forest on labelled findings (value, before, after, label)."""
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed,
        featureSubsetStrategy="sqrt",
    )
    return forest.fit(with_features(labelled))


def find_candidates(docs: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """``keys``, start (0-based, in characters), value, before and after of every candidate.

    ``before`` and ``after`` are the text around the candidate, whatever it
    holds. Candidates by themselves and those by their place may overlap;
    equal ones are one. Null and empty texts have none.
    """
    text, row = "text", "row"
    left = lambda c: F.substring(c, -LEFT_CHARS, LEFT_CHARS)
    right = lambda c: F.substring(c, 1, RIGHT_CHARS)
    held = docs.select(col("text").alias(text), *[c.alias(k) for k, c in keys.items()]).filter(
        F.col(text).rlike(CANDIDATE) | F.col(text).rlike(ASSIGNED)
    ).withColumn(row, F.monotonically_increasing_id())

    def found_by(pattern: str, kind: int) -> DataFrame:
        pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        each = held.filter(F.col(text).rlike(pattern)).select(*keys, row, pieces.alias("pieces"), found.alias("found"))
        return each.select(
            *keys, row, F.lit(kind).alias("kind"),
            F.posexplode(F.transform(F.sequence(F.lit(1), F.size("found")), lambda i: F.struct(
                F.element_at("found", i).alias("value"),
                F.length(F.element_at("pieces", i)).alias("gap"),
                left(F.element_at("pieces", i)).alias("before"),
                right(F.element_at("pieces", i + 1)).alias("after"),
            ))).alias("number", "at"),
        ).select(*keys, row, "kind", "number", "at.*")

    each = found_by(CANDIDATE, 0).unionByName(found_by(ASSIGNED, 1))
    own = Window.partitionBy(row, "kind").orderBy("number")
    upto = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.sum((F.col("gap") + F.length("value")).cast("long")).over(upto) - F.length("value")
    # So many neighbours are as long as the text around, even where nothing is between them.
    earlier = F.collect_list(F.concat("before", left(F.col("value")))).over(own.rowsBetween(-(LEFT_CHARS // SHORTEST), -1))
    later = F.collect_list(F.concat(right(F.col("value")), "after")).over(own.rowsBetween(1, RIGHT_CHARS // SHORTEST))
    placed = each.select(
        *keys, row, start.alias("start"), "value",
        left(F.concat(F.array_join(earlier, ""), "before")).alias("before"),
        right(F.concat("after", F.array_join(later, ""))).alias("after"),
    )
    return placed.dropDuplicates([row, "start", "value"]).select(*keys, "start", "value", "before", "after")


def scan(docs: DataFrame, model: RandomForestClassificationModel | None = None, threshold: float = THRESHOLD,
         keys: dict[str, Column] | None = None) -> DataFrame:
    """doc_id (or ``keys``), start, length, value, score and is_secret of every candidate.

    ``score`` is the forest's probability of a secret. Without a model one is
    fitted on ``labelled_findings``. Repeated rows are scanned each on their
    own; documents without candidates have no row.
    """
    keys = keys or {"doc_id": col("doc_id").cast("long")}
    model = model or fit_forest(labelled_findings(docs.sparkSession))
    scored = model.transform(with_features(find_candidates(docs, keys)))
    score = vector_to_array("probability")[1]
    return scored.select(
        *keys, "start", F.length("value").cast("long").alias("length"), "value", F.round(score, 6).alias("score"),
        (score >= threshold).alias("is_secret"),
    )


def redact(docs: DataFrame, model: RandomForestClassificationModel | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with every found secret replaced by ``SECRET_MARK`` at its place; all rows stay.

    Secrets that overlap are one mark. The same characters elsewhere in the
    text stay unless they are found there as well. A column ``n_chars`` is set
    to the new length where a text changed. Rows are matched by doc_id and a
    hash of the text, so the list of places of a key is bounded by one text.
    """
    key_id, key_text, secrets, made = (unused_name(docs, x) for x in ("secret_id", "secret_text", "secrets", "new_text"))
    keys = {key_id: col("doc_id"), key_text: F.xxhash64(col("text"))}
    found = scan(docs, model, threshold, keys).filter("is_secret").select(
        key_id, key_text, F.col("start").alias("s"), (F.col("start") + F.col("length")).alias("e")
    ).distinct()
    in_text = Window.partitionBy(key_id, key_text).orderBy("s", "e")
    reached = F.max("e").over(in_text.rowsBetween(Window.unboundedPreceding, -1))
    runs = found.withColumn("opens", F.coalesce(F.col("s") >= reached, F.lit(True)).cast("int")).withColumn(
        "run", F.sum("opens").over(in_text.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    places = runs.groupBy(key_id, key_text, "run").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    lists = landed(
        places.groupBy(key_id, key_text).agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias(secrets)), "secrets"
    )
    # The pieces between the places: from the end of one to the start of the next.
    from_ = F.concat(F.array(F.lit(0).cast("long")), F.transform(col(secrets), lambda x: x["e"]))
    upto = F.concat(F.transform(col(secrets), lambda x: x["s"]), F.array(F.length(col("text")).cast("long")))
    pieces = F.zip_with(from_, upto, lambda a, b: F.substring(col("text"), (a + 1).cast("int"), (b - a).cast("int")))
    clean = F.array_join(pieces, SECRET_MARK)
    joined = docs.join(
        sized_broadcast(lists), col("doc_id").eqNullSafe(col(key_id)) & (F.xxhash64(col("text")) == col(key_text)), "left"
    ).withColumn(made, F.when(col(secrets).isNull(), col("text")).otherwise(clean))

    def out(name: str) -> Column:
        if name == "text":
            return col(made).alias("text")
        if name == "n_chars":
            length = F.when(col(secrets).isNull(), col(name)).otherwise(F.length(col(made)))
            return length.cast(docs.schema[name].dataType).alias(name)
        return col(name)

    return joined.select(*[out(c) for c in docs.columns])
