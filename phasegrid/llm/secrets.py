"""Secret scans: token candidates judged by a random forest.

Candidates, of which the forest decides: a maximal run of ``[A-Za-z0-9+/_-]`` of ``min_length``
characters or more that holds a digit or changes from lower to upper case; a token with a known start,
with or without digits; a quoted or bare value of four characters or more, of any alphabet, assigned
to a name with a secret word; what follows ``Bearer``; the password of a URL; a PEM private key as a
whole. ``=`` ends a name, and at the end of a run it pads the value. Where two begin at one place the
more specific is taken. Features are DataFrame expressions: length, shares of character kinds, transitions
between kinds and between letters, dictionary coverage, the document's path and the neighbouring
words. The forest is trained on the driver from labelled findings, rows of (text, path, secret,
label); it travels as one literal, and each tree is walked by a higher-order function, so a
document never leaves the JVM.

``labelled_findings`` makes a labelled set from a seed, since the tables hold none: keys and tokens
in assignments and headers against identifiers, checksums, words, card and phone numbers, paths and
placeholders. A caller may pass its own.

Offsets are code points. Null texts count as empty and have no candidates; a null path is an empty
one. U+0001 and U+0002 count as spaces. A text of any length is read whole, in linear time. Ids needn't
be unique, and repeated rows give repeated findings. An empty table gives an empty result. Extra
columns are ignored.
"""

from __future__ import annotations

import json
import random
import re
import string
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from phasegrid.llm.shared import text_or_empty

ALPHABET = r"A-Za-z0-9+/_=\-"
#: What runs are made of; ``=`` ends a name and may only pad a value.
RUN = r"A-Za-z0-9+/_\-"
#: Words whose letters are dictionary coverage, not entropy.
DICTIONARY = (
    "account address album answer array author backup base bench block board book branch browser bucket build button cache camera center change "
    "channel class client cloud code color column comment commit common company config connect content context control cookie copy count country course "
    "create custom data debug default delete demo design detail device direct document domain download driver editor element email engine error event "
    "example export extend failure feature field file filter final folder format frame function game general global graph group handler header height hello "
    "history home host image import index info input install internal item java kernel label language layout length level library license line link list "
    "loader local location login main manager master media member memory menu message method mobile model module monitor mouse movie music name network "
    "node note number object office online open option order output package page panel parser path phone photo placeholder player plugin point policy "
    "portal post preview private process product profile program project public query question reader record release remote report request resource response "
    "result return review route sample screen script search section select sensor server service session setting shell simple site source space stack "
    "standard start state static status storage store stream string style submit summary support switch system table target task team template test text "
    "theme thread time title tool track tree type unit update upload user utils value vector version video view web width window word world write your"
).split()
CONTEXT = 48
SECRET_WORDS = r"(?i)(token|secret|passw|pwd|api[_ -]?key|apikey|auth|bearer|credential|private[_ -]?key|access[_ -]?key|signature)"
HARMLESS_WORDS = r"(?i)(sha\d*|md5|commit|checksum|digest|hash|uuid|guid|revision|example|dummy|sample|isbn|card|phone|order|invoice|integrity|etag|version|placeholder)"
TEST_PATH = r"(?i)(test|example|sample|fixture|mock|docs?/|\.lock|readme)"
#: Values that stand for a secret.
STAND_IN = (
    r"^(none|null|true|false|string|str|text|bytes|int|required|optional|password|passwd|pass|secret|token|hidden|redacted|undefined|empty)\W*$|"
    r"change_?-?me|placeholder|example|your[_-]|^[x*.]+$|\$\{|^\$[a-z_]+$|^%|^<|\{\{|environ|getenv|process\.env|config\.|self\.|args\.|settings\."
)
KNOWN_START = r"^(AKIA|ASIA|gh[pousr]_|github_pat_|glpat-|sk-|sk_live_|rk_live_|xox[abprs]-|AIza|eyJ|npm_|pypi-|SG\.)"

#: Words that name a secret, behind a guard on their first letters.
_NAME = r"(?=[TtSsPpAaCc][OoEeIiAaWwRrUuPpCc])(?i:token|s(?:ecret|igning[_ \-]?key)|p(?:ass(?:w(?:or)?d|phrase|wd)|wd|rivate[_ \-]?key)|a(?:uth|(?:pi|ccess)[_ \-]?key)|credential)\w{0,12}"
_ASSIGN = rf"""{_NAME}["'`]?\]?\s{{0,3}}(?:=>|:=|[:=])\s{{0,3}}(?:(?i:bearer|basic)\s{{1,3}})?"""


def _pattern(min_length: int) -> str:
    """Alternatives of a prefix, which may be empty, and a value; see ``_marked``. Each alternative
    fails on its first character almost everywhere, since all are tried at every place."""
    run = rf"[{RUN}]"

    def quoted(q: str) -> str:
        # A text of several words that holds a long run isn't one value: the run is a candidate.
        return rf"(?<={q})(?:[^{q}\s]{{4,}}+(?={q})|(?![^{q}\n]{{0,200}}{run}{{16}})[^{q}\n]{{4,200}}+(?={q}))"

    bare = r"""(?<!["'`])(?!//)[^\s"'`,;&<>(){}\[\]|\\]{4,}+"""
    signed = rf"(?:eyJ|SG\.){run}{{8,}}+\.{run}++(?:\.{run}++)?"
    known = rf"(?:AKIA|ASIA|gh[pousr]_|github_pat_|glpat-|sk-|sk_live_|rk_live_|xox[abprs]-|AIza|npm_|pypi-){run}{{12,}}+"
    plain = rf"(?={run}{{{min_length}}})(?=[A-Za-z+/_\-]*(?:[0-9]|[a-z][A-Z])){run}++"
    return "|".join(
        [
            r"()(-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----[A-Za-z0-9+/=\s]*+(?:-----END [A-Z ]{0,30}PRIVATE KEY-----)?)",
            r"""(:(?<=[A-Za-z0-9+.\-]{2}:)//[^\s/:@"'<>]{0,100}:)([^\s/@"'<>]{1,200}+(?=@))""",
            rf"({_ASSIGN}[\"'`]?+)({quoted('"')}|{quoted("'")}|{quoted("`")}|{bare})",
            rf"((?=[Bb])(?i:bearer)\s{{1,3}})({run}{{8,}}+={{0,2}}+)",
            rf"()((?<!{run})(?:(?=[A-Zegsrxnp]{run}{{2}})(?:{signed}|{known})|{plain})={{0,2}}+)",
        ]
    )


def _marked(text: Column, pattern: str) -> Column:
    n = re.compile(pattern).groups
    before, value = ("".join(f"${i}" for i in range(k, n + 1, 2)) for k in (1, 2))
    return F.regexp_replace(text, pattern, f"{before}\u0001{value}\u0002")


def running(sizes: Column, step: int = 256) -> Column:
    """The sum of all earlier elements for each of an array. Sums are taken in chunks of ``step``, so
    that the appends copy short arrays only."""

    def sums(values: Column) -> Column:
        empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(values, empty, lambda acc, x: F.struct((acc["at"] + x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")))["out"]

    chunks = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size(sizes) / step).cast("int") - 1)), lambda c: F.slice(sizes, c * step + 1, F.lit(step)))
    firsts = sums(F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda a, b: a + b)))
    zipped = F.arrays_zip(chunks.alias("chunk"), firsts.alias("first"))
    return F.flatten(F.transform(zipped, lambda z: F.transform(sums(z["chunk"]), lambda x: x + z["first"])))


def candidates(docs: DataFrame, path: str | None = None, min_length: int = 16) -> DataFrame:
    """(doc_id, path, start, value, before, after) of each candidate of ``docs(doc_id, text)``. The
    pattern reads a text once; a value starts at the running length of the pieces before it."""
    pattern = _pattern(min_length)
    text, marks = text_or_empty(), "\u0001\u0002"
    text = F.when(text.contains(marks[0]) | text.contains(marks[1]), F.translate(text, marks, "  ")).otherwise(text)
    where = F.coalesce(F.col(path).cast("string"), F.lit("")) if path else F.lit("")
    # Exploded, so that the filter isn't pushed below and the pattern isn't run twice.
    marked = F.explode(F.array(F.split(_marked(text, pattern), "\u0001")))
    pieces = docs.select("doc_id", where.alias("path"), marked.alias("p")).where(F.size("p") > 1)
    plain = F.transform("p", lambda x: F.replace(x, F.lit("\u0002")))
    pieces = pieces.select("doc_id", "path", "p", plain.alias("plain"), F.transform(plain, F.char_length).alias("sizes"))
    pieces = pieces.select("doc_id", "path", "p", "plain", running(F.col("sizes")).alias("starts"))
    rows = F.transform(
        F.slice("p", 2, F.size("p")),
        lambda piece, i: F.struct(
            F.get("starts", i + 1).cast("long").alias("start"),
            F.substring_index(piece, "\u0002", 1).alias("value"),
            F.right(F.get("plain", i), F.lit(CONTEXT)).alias("before"),
            F.left(F.substring_index(piece, "\u0002", -1), F.lit(CONTEXT)).alias("after"),
        ),
    )
    return pieces.select("doc_id", "path", F.explode(rows).alias("c")).select("doc_id", "path", "c.*")


def features() -> list[tuple[str, Column]]:
    """Named features over the columns of ``candidates``, all doubles."""
    value, lower = F.col("value"), F.lower("value")
    size = F.char_length(value).cast("double")

    def share(pattern: str, of: Column = value) -> Column:
        return F.regexp_count(of, F.lit(pattern)) / size

    def flag(condition: Column) -> Column:
        return condition.cast("double")

    words = "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w)))
    return [
        ("length", size),
        ("digits", share("[0-9]")),
        ("upper", share("[A-Z]")),
        ("marks", share(r"[+/_=\-]")),
        ("kind_changes", share("[a-z](?=[A-Z0-9])|[A-Z](?=[a-z0-9])|[0-9](?=[A-Za-z])")),
        ("vowel_changes", share("[aeiou](?=[b-df-hj-np-tv-z])|[b-df-hj-np-tv-z](?=[aeiou])", lower)),
        ("distinct", F.size(F.array_distinct(F.split(value, ""))) / size),
        ("hex", flag(lower.rlike("^[0-9a-f]+$"))),
        ("numeric", flag(value.rlike("^[0-9_+=/-]+$"))),
        ("uuid", flag(lower.rlike("^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"))),
        ("others", share(rf"[^{ALPHABET}]")),
        ("spaces", share(r"\s")),
        ("pem", flag(value.startswith("-----BEGIN"))),
        ("url_password", flag(F.col("before").rlike(r"://[^\s/@]*:$") & F.col("after").startswith("@"))),
        ("stand_in", flag(lower.rlike(STAND_IN))),
        ("known_start", flag(value.rlike(KNOWN_START))),
        ("dictionary", 1.0 - F.char_length(F.regexp_replace(lower, words, "")) / size),
        ("test_path", flag(F.col("path").rlike(TEST_PATH))),
        ("secret_word", flag(F.col("before").rlike(SECRET_WORDS))),
        ("harmless_word", flag(F.concat_ws(" ", "before", F.left(F.col("after"), F.lit(12))).rlike(HARMLESS_WORDS))),
        ("assigned", flag(F.col("before").rlike(r"""([=:]|[Bb]earer|=>)\s*["'`]?$"""))),
        ("quoted", flag(F.col("before").rlike(r"""["'`]$""") & F.col("after").rlike(r"""^["'`]"""))),
    ]


def labelled_findings(count: int = 8000, seed: int = 7) -> list[tuple[str, str, int]]:
    """(text, path, label): each text holds a candidate, a secret where label is 1."""
    r = random.Random(seed)
    pick = lambda alphabet, low, high: "".join(r.choice(alphabet) for _ in range(r.randint(low, high)))
    hexes, base, letters = "0123456789abcdef", string.ascii_letters + string.digits, string.ascii_lowercase
    names = ["token", "secret", "password", "api_key", "API_KEY", "auth", "access_key", "private_key", "client_secret", "db_passwd"]
    plain = ["id", "name", "key", "value", "ref", "file", "path", "title", "label", "slug"]
    harmless = ["sha256", "md5", "commit", "checksum", "digest", "uuid", "revision", "etag", "integrity", "order", "card", "phone"]
    paths = ["src/app.py", "config/prod.yml", "main.go", "", "", "web/index.js", ".env"]
    test_paths = ["tests/test_api.py", "docs/readme.md", "examples/demo.py", "yarn.lock", "fixtures/a.json"]
    prose = lambda: " ".join(pick(letters, 2, 8) for _ in range(r.randint(2, 8)))
    filler = lambda: prose() + r.choice([" ", ". ", "\n"])
    assign = lambda name, v: r.choice([f'{name} = "{v}"', f"{name}='{v}'", f"{name}: {v}", f"{name}={v}", f'"{name}": "{v}"', f"{name} => '{v}'"])
    marks = "!$@:.#%^*?~"
    word = lambda: r.choice([r.choice(DICTIONARY), pick(letters, 3, 9)])
    vendor = ["sk_live_", "ghp_", "glpat-", "npm_", "xoxb-"]

    def password() -> str:
        """Short ones, of any alphabet."""
        made = [pick(base, 6, 13), r.choice(marks), pick("0123456789", 1, 3)]
        r.shuffle(made)
        return r.choice(["".join(made), pick(base, 8, 15), word().capitalize() + pick("0123456789", 2, 4) + r.choice(marks), r.choice(marks).join(pick(base, 5, 12) for _ in range(3))])

    def odd(label: int) -> str:
        """What isn't one long run with a digit."""
        url = lambda user, v: f"{r.choice(['postgres', 'mysql', 'amqp', 'https', 'mongodb+srv'])}://{user}:{v}@{word()}.{r.choice(['com', 'local:5432', 'internal'])}/{word()}"
        kind = r.randrange(6)
        if label:
            if kind == 0:
                return assign(r.choice(names), password())
            if kind <= 2:
                v = r.choice(["-", "_", "."]).join(word() for _ in range(r.randint(3, 5)))
                return r.choice([f'{r.choice(names)} = "{v}"', f"{r.choice(names)}='{v}'", f'password: "{v.replace("-", " ")}"', f'passphrase = "{v}"'])
            if kind == 3:
                return r.choice([lambda: assign(r.choice(names + plain), r.choice(vendor) + pick(string.ascii_letters, 20, 36)), lambda: assign(r.choice(names), pick(string.ascii_letters, 16, 40)), lambda: r.choice(vendor) + pick(string.ascii_letters, 24, 36)])()
            if kind == 4:
                return url(word(), password().replace("@", "-"))
            head = r.choice(["RSA ", "EC ", "", "OPENSSH "])
            return f"-----BEGIN {head}PRIVATE KEY-----\n" + "\n".join(pick(base + "+/", 64, 64) for _ in range(r.randint(1, 4))) + f"\n-----END {head}PRIVATE KEY-----"
        if kind <= 1:
            stand_in = ["changeme", "your-password-here", "${DB_PASSWORD}", "********", "<password>", "xxxxxxxx", "None", "null", "string", "required", "os.environ", "config.token", "example", "placeholder"]
            return assign(r.choice(names), r.choice(stand_in))
        if kind == 2:
            return r.choice([f"{r.choice(names)}: {word()} {prose()}", f"the {r.choice(['password', 'token', 'secret'])}: {word()}", f"{r.choice(['Author', 'Authority', 'tokens', 'Secretary'])}: {word().capitalize()} {prose()}"])
        if kind == 3:
            return r.choice(["", "see ", "call "]) + r.choice(DICTIONARY) + "".join(w.capitalize() for w in r.sample(DICTIONARY, 3))
        if kind == 4:
            return url(r.choice(["user", "username", "admin"]), r.choice(["password", "pass", "<password>", "${PASSWORD}", "xxxx", "secret"]))
        return assign(r.choice(plain), r.choice([pick(letters, 14, 24) + str(r.randint(10, 999)), "".join(w.capitalize() for w in r.sample(DICTIONARY, 4))]))

    out = []
    for _ in range(count):
        label = int(r.random() < 0.45)
        path = r.choice(test_paths) if r.random() < (0.05 if label else 0.3) else r.choice(paths)
        if r.random() < 0.4:
            out.append((filler() + odd(label) + r.choice(["", "\n", " "]) + prose(), path, label))
            continue
        if label:
            value = r.choice(
                [lambda: pick(hexes, 40, 40), lambda: pick(hexes, 32, 64), lambda: pick(base, 24, 48), lambda: pick(base + "+/", 40, 44),
                 lambda: "AKIA" + pick(string.ascii_uppercase + string.digits, 16, 16), lambda: "ghp_" + pick(base, 36, 36), lambda: "sk_live_" + pick(base, 24, 32)]
            )()
            known = value.startswith(("AKIA", "ghp_", "sk_live_"))
            text = assign(r.choice(plain if known and r.random() < 0.4 else names), value) if r.random() < 0.85 else f"Authorization: Bearer {value}"
        else:
            kind = r.randrange(9)
            if kind == 0:
                text = assign(r.choice(harmless), pick(hexes, 32, 64))
            elif kind == 1:
                text = assign(r.choice(plain + harmless), "-".join(pick(hexes, n, n) for n in (8, 4, 4, 4, 12)))
            elif kind == 2:
                text = "_".join(r.choice(DICTIONARY) for _ in range(3)) + r.choice(["_", ""]) + str(r.randint(1, 99))
            elif kind == 3:
                text = prose() + " " + pick("0123456789", 16, 19)
            elif kind == 4:
                text = assign(r.choice(names), r.choice(DICTIONARY) + "_" + r.choice(["placeholder", "example", "changeme", "sample"]) + "_" + str(r.randint(100, 99999)))
            elif kind == 5:
                text = "/".join(r.choice(DICTIONARY) for _ in range(r.randint(3, 5))) + "/v" + str(r.randint(1, 9))
            elif kind == 6:
                text = pick(letters, 14, 24) + str(r.randint(0, 999))
            elif kind == 7:
                text = f"{r.choice(['commit', 'revision', 'see'])} {pick(hexes, 40, 40)}"
            else:
                text = assign(r.choice(plain), "".join(w.capitalize() for w in r.sample(DICTIONARY, 3)) + str(r.randint(0, 99)))
        out.append((filler() + text + r.choice(["", "\n", " "]) + prose(), path, label))
    return out


@dataclass(frozen=True)
class Forest:
    """Complete binary trees: ``feature`` and ``limit`` of each inner node, ``leaf`` shares of 1."""

    feature: list[list[int]]
    limit: list[list[float]]
    leaf: list[list[float]]
    depth: int


def grow(x: np.ndarray, y: np.ndarray, trees: int = 31, depth: int = 6, seed: int = 7) -> Forest:
    """Bootstrap rows, try a random third of the features at each node, split by Gini impurity."""
    r = np.random.default_rng(seed)
    tries = max(2, x.shape[1] // 3)
    features_, limits, leaves = [], [], []
    for _ in range(trees):
        rows = r.integers(0, len(x), len(x))
        feature, limit, leaf = [0] * (2**depth - 1), [float("inf")] * (2**depth - 1), [0.0] * 2**depth
        todo = [(0, rows, float(y[rows].mean()) if len(rows) else 0.5)]
        while todo:
            node, own, share = todo.pop()
            if node >= 2**depth - 1:
                leaf[node - (2**depth - 1)] = (y[own].sum() + share) / (len(own) + 1)
                continue
            best = (1e-9, 0, float("inf"))
            if len(own) >= 8 and 0 < y[own].mean() < 1:
                whole = y[own].mean()
                for f in r.choice(x.shape[1], tries, replace=False):
                    values = np.unique(x[own, f])
                    if len(values) < 2:
                        continue
                    cuts = (values[1:] + values[:-1]) / 2
                    for c in cuts if len(cuts) <= 16 else cuts[np.linspace(0, len(cuts) - 1, 16).astype(int)]:
                        low = x[own, f] <= c
                        n, a, b = low.mean(), y[own][low].mean(), y[own][~low].mean()
                        gain = whole * (1 - whole) - n * a * (1 - a) - (1 - n) * b * (1 - b)
                        if gain > best[0]:
                            best = (gain, int(f), float(c))
            feature[node], limit[node] = best[1], best[2]
            low = x[own, best[1]] <= best[2]
            share = (y[own].sum() + share) / (len(own) + 1)
            todo += [(2 * node + 1, own[low], share), (2 * node + 2, own[~low], share)]
        features_.append(feature)
        limits.append([min(v, 1e300) for v in limit])
        leaves.append(leaf)
    return Forest(features_, limits, leaves, depth)


#: Forests of the generated set by (trees, depth): they depend on nothing else, so a driver grows one once.
_grown: dict[tuple[int, int], Forest] = {}


def train(spark: SparkSession, findings: list[tuple[str, str, int]] | None = None, trees: int = 31, depth: int = 6) -> Forest:
    """Features come from the same expressions that score documents; the set is the caller's, or
    that of ``labelled_findings``, and fits the driver by its own size."""
    own = findings is None
    if own and (trees, depth) in _grown:
        return _grown[trees, depth]
    findings = labelled_findings() if own else findings
    rows = spark.createDataFrame([(i, *f) for i, f in enumerate(findings)], "doc_id long, text string, path string, label int")
    found = candidates(rows, "path").select("doc_id", *[c.alias(n) for n, c in features()])
    got = found.join(rows.select("doc_id", "label"), "doc_id").orderBy("doc_id").collect()
    names = [n for n, _ in features()]
    x = np.array([[r[n] for n in names] for r in got], dtype=np.float64).reshape(-1, len(names))
    forest = grow(x, np.array([r["label"] for r in got], dtype=np.float64), trees, depth)
    if own:
        _grown[trees, depth] = forest
    return forest


def forest_score(forest: Forest, x: Column) -> Column:
    """The mean leaf of all trees for the feature array ``x``."""
    rows = [{"feature": f, "limit": t, "leaf": v} for f, t, v in zip(forest.feature, forest.limit, forest.leaf, strict=True)]
    trees = F.from_json(F.lit(json.dumps(rows)), "array<struct<feature: array<int>, limit: array<double>, leaf: array<double>>>")
    inner = 2**forest.depth - 1

    def walk(tree: Column) -> Column:
        end = F.aggregate(
            F.sequence(F.lit(1), F.lit(forest.depth)),
            F.lit(0),
            lambda node, _: node * 2 + F.when(F.get(x, F.get(tree["feature"], node)) <= F.get(tree["limit"], node), 1).otherwise(2),
        )
        return F.get(tree["leaf"], end - inner)

    return F.aggregate(F.transform(trees, walk), F.lit(0.0), lambda a, b: a + b) / len(forest.leaf)


def scored(docs: DataFrame, forest: Forest, path: str | None = None) -> DataFrame:
    """All candidates with their score."""
    found = candidates(docs, path)
    # Exploded, so that the optimiser doesn't put the features into each step of each tree.
    x = F.explode(F.array(F.array(*[c for _, c in features()])))
    return found.withColumn("x", x).withColumn("score", F.round(forest_score(forest, F.col("x")), 9)).drop("x")


def secrets(docs: DataFrame, forest: Forest, path: str | None = None, least: float = 0.5) -> DataFrame:
    """Findings that the forest takes for secrets: doc_id, start, length, value_sha256, score."""
    return scored(docs, forest, path).where(F.col("score") >= least).select(
        F.col("doc_id").cast("long").alias("doc_id"), "start", F.char_length("value").cast("long").alias("length"),
        F.sha2("value", 256).alias("value_sha256"), "score",
    )
