"""Secret scans with a random forest that removes false positives (operator 10); DataFrame and SQL functions only.

Patterns propose candidate values in every text.  A random forest on a candidate's length, character transitions,
dictionary coverage, path and neighbouring words decides which are secrets; a value is one if any of its places in the
text is judged so.  Dictionary and letter pairs are counted over all documents.  The forest is trained on labelled
findings, built in SQL from a bounded sample of the documents: values of secret formats, and look-alikes (place-holders,
words, paths, digests beside words that say so) put into the documents' own surroundings.  The fitted trees are then
spelt as SQL, so that scanning is one projection over the documents without an exchange.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import columns, scratch, table

#: The fit's bound: so many documents (lowest hash first) give the surroundings of labelled findings.
FIT_ROWS = 800
#: The dictionary's bound: so many of the most frequent words of all documents.
DICTIONARY = 2_000
TREES, DEPTH, SEED = 24, 6, 17
MARK = "[SECRET]"

# Words that announce a secret, formats of well-known keys, words that announce something else.
KEY_WORDS = ("password|passwd|passphrase|pwd|secret|token|api[_-]?key|apikey|access[_-]?key|auth|credentials?|bearer|"
             "private[_-]?key|client[_-]?secret")
FORMATS = (r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b|\bgh[pousr]_[A-Za-z0-9]{36}\b|\bxox[baprs]-[A-Za-z0-9-]{10,}|\bAIza[0-9A-Za-z_-]{35}"
           r"|\bsk-[A-Za-z0-9]{20,}|\beyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+")
#: Words; how many, from all over a text, and how much of a long one, made findings draw on; words for texts of few.
WORD, WORDS, WORD_CHARS = "[a-z]{3,}", 64, 24
FILL = "the and for with from this that have not are was but you all can one our out day get has him his how new now old see two way"
HARMLESS = "commit|sha1|sha256|md5|digest|checksum|hash|uuid|etag|build|version|integrity|revision"

#: A key word, alone or inside a longer identifier, its sign, and ahead of it the whole value: up to the closing quote on
#: its line, else up to white space or a quote that ends something around it.
VALUE = (r"(?<=\x22)[^\x22\r\n]{6,}+(?=\x22)|(?<=\x27)[^\x27\r\n]{6,}+(?=\x27)"
         r"|(?:[^\s\x22\x27]|[\x22\x27](?=[^\s\x22\x27,;:.)\]}>#])){6,}+")
IDENTIFIER = rf"(?i)(?:{KEY_WORDS})[A-Za-z0-9_.-]*+"
KEYED = rf"{IDENTIFIER}[\x22']?[\x20\t]{{0,3}}[:=][\x20\t]{{0,3}}(?:\x22{{3}}|\x27{{3}}|[\x22'])?+(?=({VALUE}))"
#: What may end the sentence instead of the value: without it the value is a candidate too, for its places elsewhere.
TRAIL = r"[,;:.)\]}>]+$"
LONG = r"[A-Za-z0-9+/_-]{20,}={0,2}"


def _sql(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\x27") + "'"


#: Candidate values of the column ``text``, each once, in a fixed order.
CANDIDATES = f"""array_sort(array_distinct(filter(concat(
    regexp_extract_all(text, {_sql(FORMATS)}, 0),
    flatten(transform(regexp_extract_all(text, {_sql(KEYED)}, 1), v -> array(v, regexp_replace(v, {_sql(TRAIL)}, '')))),
    filter(regexp_extract_all(text, {_sql(LONG)}, 0), v -> v rlike '[0-9]' and v rlike '[A-Za-z]')), v -> length(v) >= 6)))"""

FEATURES = ("length", "digits", "capitals", "smalls", "others", "transitions", "variety", "repeats", "unlikely", "dictionary",
            "path", "keyed", "harmless", "format", "quoted")
#: Features of a place (the others are the value's own), and how many characters around it they may look at.
PLACE = ("path", "keyed", "harmless", "quoted")
BEFORE, AFTER = 47, 24


def features(c: str, words: list[str], steps: dict[str, float], of: tuple = FEATURES) -> str:
    """SQL of the struct of the features ``of`` a candidate ``c`` with value, before and after."""
    v, n = f"{c}.value", f"length({c}.value)"
    share = lambda keep: f"length(regexp_replace({v}, '[^{keep}]', '')) / {n}"
    pairs = f"transform(sequence(1, greatest({n} - 1, 1)), i -> lower(substring({v}, i, 2)))"
    table_of_steps = "map(" + ", ".join(f"'{k}', {x:.4f}D" for k, x in sorted(steps.items())) + ")"
    dictionary = "array(" + ", ".join(f"'{w}'" for w in words) + ")" if words else "array('')"
    runs = f"regexp_extract_all({v}, '[A-Za-z]{{3,}}', 0)"
    changes = (f"(length(regexp_replace({v}, '[A-Z](?![A-Z])|[a-z](?![a-z])|[0-9](?![0-9])', '__')) - {n})")
    last = f"lower(coalesce(regexp_extract({c}.before, '([A-Za-z0-9_.-]+)[^A-Za-z0-9]*$', 1), ''))"
    parts = {
        "length": f"double(least({n}, 200))",
        "digits": share("0-9"), "capitals": share("A-Z"), "smalls": share("a-z"),
        "others": f"length(regexp_replace({v}, '[A-Za-z0-9]', '')) / {n}",
        "transitions": f"{changes} / {n}",
        "variety": f"size(array_distinct(split({v}, ''))) / least({n}, 36)",
        "repeats": f"length(regexp_replace({v}, '(.)(?!\\\\1)', '')) / {n}",
        "unlikely": f"aggregate({pairs}, 0D, (a, p) -> a + coalesce(element_at({table_of_steps}, p), -9D)) / greatest({n} - 1, 1)",
        "dictionary": f"aggregate(filter({runs}, w -> array_contains({dictionary}, lower(w))), 0, (a, w) -> a + length(w)) / {n}",
        "path": f"IF({c}.before rlike '[/\\\\\\\\]$' or {v} rlike '^[a-z]+(/[a-z._-]+)+' or {c}.before rlike '(?i)https?://[^ ]*$', 1D, 0D)",
        "keyed": f"IF({last} rlike '(?i)({KEY_WORDS})' and {c}.before rlike '[:=][^A-Za-z0-9]*$', 1D, 0D)",
        "harmless": f"IF({last} rlike '({HARMLESS})', 1D, 0D)",
        "format": f"IF({v} rlike {_sql('^(?:' + FORMATS + ')$')}, 1D, 0D)",
        "quoted": f"IF({c}.before rlike '[\\\\x22\\\\x27]$' and {c}.after rlike '^[\\\\x22\\\\x27]', 1D, 0D)",
    }
    return "named_struct(" + ", ".join(f"'{k}', double({parts[k]})" for k in of) + ")"


#: Candidates with first place (characters from 0) and the pieces of the text between their places.
FOUND = rf"""transform({CANDIDATES}, v -> named_struct('value', v, 'start', instr(text, v) - 1,
    'pieces', split(text, regexp_replace(v, r'([^A-Za-z0-9])', r'\\$1'), -1)))"""
#: The same with the surroundings of every place, alike ones once.  Values have 6 characters or more: of the pieces before
#: (behind) a place, with the value between them, the nearest 9 (5) fill the surroundings.
PLACES = f"""transform(_c, c -> named_struct('value', c.value, 'start', c.start, 'places', array_distinct(transform(
    sequence(1, size(c.pieces) - 1), i -> named_struct('value', c.value,
        'before', right(array_join(transform(slice(c.pieces, greatest(i - 8, 1), least(i, 9)), x -> right(x, {BEFORE})), c.value), {BEFORE}),
        'after', left(array_join(transform(slice(c.pieces, i + 1, 5), x -> left(x, {AFTER})), c.value), {AFTER}))))))"""


def corpus_words(docs: DataFrame) -> tuple[list[str], dict[str, float]]:
    """The frequent words of all documents, and the log-probabilities of letter pairs (at most 26 x 26) in all their words.

    A word counts once a document, so that what stands in one document alone, as a secret's letters do, weighs little.
    """
    counts = scratch(docs.select(F.explode(F.array_distinct(F.expr(f"regexp_extract_all(lower(text), '{WORD}', 0)"))).alias("word"))
                     .groupBy("word").count(), "words")
    words = [r["word"] for r in counts.orderBy(F.desc("count"), "word").limit(DICTIONARY).collect()]
    pairs = {r["pair"]: r["n"] for r in counts.select("count", F.explode(F.expr(
        "transform(sequence(1, length(word) - 1), i -> substring(word, i, 2))")).alias("pair"))
        .groupBy("pair").agg(F.sum("count").alias("n")).collect()}
    total = Counter()
    for p, n in pairs.items():
        total[p[0]] += n
    return words, {p: math.log(n / total[p[0]]) for p, n in pairs.items()}


def labelled_findings(docs: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Findings (value, before, after, label) built from a bounded sample of the texts, of whatever length.

    Texts of few words are filled up from a fixed list, and a small table's texts serve several times, so that about
    as many findings come of any table with a text.
    """
    texts = docs.where(F.col("text").isNotNull()).select("text", F.xxhash64("id", "text").alias("o"))
    least = scratch(texts.select("o").orderBy("o").limit(fit_rows), "sample")       # hashes only: the texts come by a join
    n_texts = least.distinct().count()
    if not n_texts:
        return docs.sparkSession.createDataFrame([], "value string, before string, after string, label double")
    own = f"regexp_extract_all(lower(text), '{WORD}', 0)"
    w = (texts.join(F.broadcast(least.distinct()), "o")
         .select("o", F.expr(own).alias("w")).withColumn("w", F.expr(f"IF(size(w) >= 8, w, concat(w, split('{FILL}', ' ')))"))
         .select("o", F.expr(f"transform(sequence(1, {WORDS}), k -> left(w[pmod(xxhash64(o, k, 'w'), size(w))], {WORD_CHARS}))").alias("w"))
         .dropDuplicates(["o"])
         .select(F.explode(F.sequence(F.lit(1), F.lit(-(-fit_rows // n_texts)))).alias("k"), "o", "w")
         .select(F.concat_ws("/", "o", "k").alias("id"), "w"))
    word = lambda k: f"w[pmod(xxhash64(id, {k}), size(w))]"
    code = lambda k, n: f"substring(sha2(concat(id, '-{k}'), 256), 1, {n})"
    b64 = lambda k, n: f"substring(replace(base64(unhex(sha2(concat(id, '+{k}'), 512))), '=', ''), 1, {n})"
    upper = "substring(translate(upper(regexp_replace(base64(unhex(sha2(concat(id, 'k'), 512))), '[^A-Za-z0-9]', 'Q')), '0189', 'ZYXW'), 1, 16)"
    around = lambda v, before, after, label: (
        f"named_struct('value', {v}, 'before', concat({word(1)}, ' ', {word(2)}, ' ', {before}), 'after', {after}, 'label', {label}D)")
    n = "cast(pmod(xxhash64(id, 9), 25) as int)"
    made = [
        around(f"concat('AKIA', {upper})", "''", "' '", 1), around(f"concat('ghp_', {b64(1, 36)})", "'= '", "' '", 1),
        around(code(1, f"12 + {n}"), "'password='", "' '", 1), around(b64(2, f"10 + {n}"), "'password: '", "' '", 1),
        around(code(2, "40"), "'token = \"'", "'\" '", 1), around(b64(3, f"16 + {n}"), "'secret = \"'", "'\" '", 1),
        around(code(3, "32"), "'api_key='", "' '", 1), around(b64(4, f"20 + {n}"), "'auth: '", "'\\n'", 1),
        around(f"translate({b64(5, f'12 + {n}')}, 'AEIOU+/', '&#$%*?!')", f"concat({word(3)}, '_password=')", "' '", 1),
        around(b64(6, "40"), "'aws_secret_access_key = '", "' '", 1), around(b64(7, f"10 + {n}"), f"concat('api_key_', {word(3)}, ': ')", "' '", 1),
        around(f"concat(initcap(substring({word(4)}, 1, 3)), '0', substring({word(5)}, 1, 3), '4&', {code(11, '4')})", "'password='", "' '", 1),
        around(f"concat(initcap({word(4)}), '#', {code(12, '4')}, '!')", f"concat({word(3)}, '.passwd = \"')", "'\" '", 1),
        around(f"concat('$(', {word(3)}, ')')", f"concat({word(4)}, '_password=')", "' '", 0),
        around(f"concat({word(3)}, '(', {word(4)}, ',')", "'access_token = '", "' '", 0),
        around(f"concat(initcap({word(3)}), ',')", "'author: '", "' '", 0), around(f"concat({word(3)}, '.', {word(4)}, ';')", "'tokenizer = '", "' '", 0),
        around(f"concat({word(3)}, '&', {word(4)}, '=', {word(5)})", "'token='", "' '", 0), around(f"concat('<', {word(6)}, '>')", "'client_secret: '", "' '", 0),
        around(f"concat({word(3)}, ' ', {word(4)}, ' ', {word(5)})", "'auth = \"'", "'\" '", 0),
        around(f"concat({word(3)}, '-', {word(4)})", "'password='", "' '", 0), around(word(5), "'token: '", "' '", 0),
        around(f"concat('your_', {word(6)}, '_here')", "'password = \"'", "'\" '", 0), around("'changeme123'", "'password='", "' '", 0),
        around(f"repeat('x', 8 + {n})", "'secret='", "' '", 0), around("'1234567890'", "'token='", "' '", 0),
        around(f"concat({word(3)}, {word(4)}, {word(5)}, {word(6)}, {word(7)}, '1')", "''", "' '", 0),
        around(f"concat({word(3)}, '/', {word(4)}, '/', {word(5)}, '/', {word(6)}, '2')", "'/'", "' '", 0),
        around(f"concat({word(3)}, '_', {word(4)}, '_', {word(5)}, '_', {word(6)}, '_v2')", "''", "' '", 0),
        around(code(4, "40"), "'commit '", "' '", 0), around(code(5, "64"), "'sha256: '", "' '", 0),
        around(code(6, "32"), "'md5='", "' '", 0), around(code(7, "40"), "'https://example.org/blob/'", "'/'", 0),
        around(f"concat(substring({code(8, '36')}, 1, 8), '-', substring({code(9, '36')}, 1, 4), '-4a11-8b22-', {code(10, '12')})", "'uuid '", "' '", 0),
    ]
    return w.select(F.explode(F.expr(f"array({', '.join(made)})")).alias("f")).select("f.*")


def _tree_sql(node, value: str, place: str) -> str:
    """A fitted tree's probability of label 1, of the feature structs of a value and of one of its places."""
    if node.subtreeDepth() == 0:
        stats = list(node.impurityStats().stats())
        return f"{stats[1] / max(sum(stats), 1e-9):.6f}D"
    split = node.split()
    name = FEATURES[split.featureIndex()]
    return (f"IF({place if name in PLACE else value}.{name} <= {split.threshold()!r}D, "
            f"{_tree_sql(node.leftChild(), value, place)}, {_tree_sql(node.rightChild(), value, place)})")


#: Secrets of a row, the longest first.
LONGEST = "reverse(array_sort(transform(secrets, s -> named_struct('n', length(s.value), 'v', s.value))))"


class Scanner:
    """The fitted forest as SQL over candidates."""

    def __init__(self, model: RandomForestClassificationModel | None, words: list[str], steps: dict[str, float]):
        self.words, self.steps = words, steps
        self.trees = [] if model is None else [t._java_obj.rootNode() for t in model.trees]

    def probability(self, value: str, place: str) -> str:
        if not self.trees:                                                          # nothing to learn from: formats only
            return f"{value}.format"
        return "(" + " + ".join(_tree_sql(t, value, place) for t in self.trees) + f") / {len(self.trees)}"

    def scan(self, docs: DataFrame, at_least: float = 0.5) -> DataFrame:
        """Adds ``candidates`` (number) and ``secrets`` (value, start, count, score by start) to rows with ``text``.

        Every place of a value is judged with its own surroundings; the highest score is the value's.  A secret that
        stands only inside longer ones is left out.
        """
        own = tuple(k for k in FEATURES if k not in PLACE)
        out = docs.withColumn("_c", F.expr(f"coalesce({FOUND}, array())")).withColumn("_d", F.expr(PLACES))
        out = out.withColumn("_f", F.expr(
            f"transform(_d, c -> named_struct('value', c.value, 'start', c.start, 'f', {features('c', self.words, self.steps, own)}, "
            f"'places', transform(c.places, p -> {features('p', self.words, self.steps, PLACE)})))"))
        out = out.withColumn("_p", F.expr("transform(_f, c -> named_struct('start', c.start, 'value', c.value, 'score', "
                                          f"array_max(transform(c.places, p -> {self.probability('c.f', 'p')}))))"))
        out = out.withColumn("secrets", F.expr(
            f"transform(array_sort(filter(_p, c -> c.score >= {at_least}D)), c -> named_struct('value', c.value, 'start', c.start, "
            "'count', cast((length(text) - length(replace(text, c.value, ''))) / length(c.value) as int), 'score', c.score))"))
        out = out.withColumn("_own", F.expr(                                        # values with a place outside longer secrets
            f"aggregate({LONGEST}, named_struct('t', text, 'own', cast(array() as array<string>)), (a, s) -> IF(instr(a.t, s.v) > 0, "
            "named_struct('t', replace(a.t, s.v, '\\n'), 'own', concat(a.own, array(s.v))), a), a -> a.own)"))
        out = out.withColumn("secrets", F.expr("filter(secrets, s -> array_contains(_own, s.value))"))
        return out.withColumn("candidates", F.size("_c")).drop("_c", "_d", "_f", "_p", "_own")


def fit(docs: DataFrame) -> Scanner:
    """Train the forest on labelled findings built from ``docs`` (id, text); without any text there is nothing to find."""
    words, steps = corpus_words(docs)
    found = labelled_findings(docs)
    x = found.withColumn("f", F.expr(features("struct(value, before, after)", words, steps))).select("label", "f.*")
    x = x.repartition(4).cache()
    try:
        if x.agg(F.countDistinct("label")).first()[0] < 2:
            return Scanner(None, words, steps)
        data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(x)
        model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt").fit(data)
        return Scanner(model, words, steps)
    finally:
        x.unpersist()


def redacted(docs: DataFrame) -> DataFrame:
    """Scanned rows with every place of every secret in ``text`` replaced, longer secrets first."""
    return docs.withColumn("text", F.expr(f"aggregate({LONGEST}, text, (t, s) -> replace(t, s.v, '{MARK}'))"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: doc_id, n_candidates, n_secrets, spans (start:length:count, by start), redacted_sha256.

    Starts and lengths are in characters, the start being that of a value's first place; all its places are counted
    and redacted.  Null and empty texts have no candidates (the hash is that of an empty text).  Repeated rows and null
    ids are scanned like all others.  An empty table gives no rows.
    """
    docs = columns(table(spark, sf_dir, "documents", "doc_id", "text"), id="doc_id", text="text")
    found = fit(docs).scan(docs)
    spans = "array_join(transform(secrets, s -> concat_ws(':', s.start, length(s.value), s.count)), ',')"
    return redacted(found.withColumn("spans", F.expr(spans))).select(
        F.col("id").alias("doc_id"), F.col("candidates").cast("long").alias("n_candidates"), F.size("secrets").cast("long").alias("n_secrets"),
        "spans", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("redacted_sha256"))
