"""Secret scan: candidates by pattern, a random forest to remove false positives.

A candidate is the value of an assignment, a long run of key characters, or a private-key
block.  The forest sees its length, character transitions, dictionary coverage, path shape and
neighbouring words.  It is trained on labelled findings ``(text, begin, end, label)``; where
nobody has labelled any, :func:`derived_findings` makes them from the documents' own
words: secrets of random characters under credential names, and the usual false alarms
(checksums, placeholders, identifiers, paths, numbers).

Edge cases: null and empty texts have no candidates.  Overlapping candidates are one, of
the first one's rule.  None has a longest length, and the features see all of it.  A value of
small letters only, or of several quoted words, is a candidate under a credential's name.  Repeated rows give repeated findings.  An empty table gives an empty
table; without any document the forest is trained on words of its own seed.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import smallest_by_hash, staged

# Words that stand next to secrets, next to harmless digests, and inside placeholders.
CREDENTIAL = ["api", "auth", "authorization", "bearer", "credential", "key", "pass", "passphrase", "passwd", "password", "private",
              "pwd", "secret", "signature", "token"]
DIGEST = ["asset", "build", "checksum", "commit", "digest", "etag", "hash", "id", "integrity", "md", "revision", "sha", "uuid", "version"]
PLACEHOLDER = ["changeme", "dummy", "example", "fake", "here", "insert", "placeholder", "sample", "test", "todo", "xxxx", "your"]

_ASSIGNED = re.compile(r"""[A-Za-z_][\w.\-]{1,40}\W{0,6}?\s?(?:=|:)\W{0,4}?\s?["']?(?P<v>[^\s"'|,;<>()]{8,})""")
_RUN = re.compile(r"[A-Za-z0-9+/_=\-]{20,}")
_QUOTED = re.compile(r"""(?P<n>[A-Za-z_][\w.\-]{1,40})["']?\s?(?:=|:)\s?(?P<q>["'])(?P<v>[^"'\n]{8,})(?P=q)""")
_BEGIN, _END = (re.compile(rf"-----{mark} [A-Z ]*PRIVATE KEY-----") for mark in ("BEGIN", "END"))
_UUID = re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}\Z")
_HEX = re.compile(r"[0-9a-fA-F]+\Z")
_LETTERS = re.compile(r"[^\W\d_]+")
_NAME = re.compile(r"[^\W\d_]+|\d+")

#: Distinct words that a task holds before it sends them on.
TASK_WORDS = 100_000
FEATURES = ["length", "entropy", "class_changes", "transition", "unseen_transitions", "coverage", "digits", "upper", "symbols", "is_hex",
            "is_uuid", "slashes", "dots", "path", "url", "repeats", "credential_near", "credential_name", "digest_near", "placeholder",
            "assigned", "quoted", "block", "distinct"]
FINDING = "struct<begin:int,end:int,rule:string,value:string,features:array<double>>"
_SHAPE = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("rule", pa.string()), ("value", pa.string()),
                             ("features", pa.list_(pa.float64()))]))


@dataclass
class Language:
    """What ordinary text looks like: frequent words, and log probabilities of letter pairs.

    The words are a set, or a text with one in each line; a task makes a set of that, so that the driver holds none.
    """

    listed: frozenset[str] | str
    pairs: dict[str, float]
    floor: float

    @cached_property
    def words(self) -> frozenset[str]:
        return frozenset(self.listed.split()) if isinstance(self.listed, str) else self.listed


def _count_words(batches):
    """Words of a task's texts by language: how often, and in how many texts; the word '' is in each."""
    often: dict[str | None, Counter[str]] = {}
    texts: dict[str | None, Counter[str]] = {}

    def send() -> pa.RecordBatch:
        kept = [(lang, w) for lang, own in texts.items() for w in own if len(w) != 1]
        columns = [[lang for lang, _ in kept], [w for _, w in kept], [often[lang][w] for lang, w in kept], [texts[lang][w] for lang, w in kept]]
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["lang", "w", "n", "docs"])

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            words = _LETTERS.findall(text.lower())
            words.append("")
            often.setdefault(lang, Counter()).update(words)
            texts.setdefault(lang, Counter()).update(set(words))
            if sum(map(len, texts.values())) > TASK_WORDS:
                yield send()
                often.clear()
                texts.clear()
    yield send()


def _list_words(batches):
    """Words of three letters or more as texts with one in each line."""
    for batch in batches:
        yield pa.record_batch([pa.array(["\n".join(w for w in batch.column("w").to_pylist() if len(w) >= 3)])], names=["lines"])


def _count_pairs(batches):
    """How often a task's words have two letters in a row."""
    pairs: Counter[str] = Counter()
    for batch in batches:
        for w, n in zip(batch.column("w").to_pylist(), batch.column("n").to_pylist(), strict=True):
            for a, b in zip(w, w[1:], strict=False):
                pairs[a + b] += n
    yield pa.record_batch([pa.array(list(pairs), pa.string()), pa.array(list(pairs.values()), pa.int64())], names=["pair", "n"])


def learn_language(docs: DataFrame, text: str = "text", share: float = 1 / 5000, lang: str = "lang") -> Language:
    """From all whole documents: the words that at least a ``share`` of a language's documents have.

    So their number is bounded by the words of a document over the share, whatever the size of the table.
    """
    of = F.col(f"`{lang}`").cast("string") if lang in docs.columns else F.lit(None).cast("string")
    counted = docs.filter(F.col(text).isNotNull()).select(of.alias("lang"), F.col(text).alias("text"))
    counted = counted.mapInArrow(_count_words, "lang string, w string, n bigint, docs bigint").groupBy("lang", "w").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counted = staged(counted, "words")
    sizes = counted.filter("w = ''").select(F.col("lang").alias("l"), F.col("docs").alias("size"))  # a row for each language
    common = counted.filter("w <> ''").join(F.broadcast(sizes), F.col("lang").eqNullSafe(F.col("l"))).filter(F.col("docs") >= F.col("size") * share)
    common = staged(common.groupBy("w").agg(F.sum("n").alias("n")), "common")
    listed = "\n".join(r["lines"] for r in common.select("w").mapInArrow(_list_words, "lines string").collect())
    counts = common.mapInArrow(_count_pairs, "pair string, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = {r["pair"]: r["n"] for r in counts.collect()}
    total = sum(pairs.values()) + 1
    return Language(listed, {p: math.log(n / total) for p, n in pairs.items()}, math.log(0.5 / total))


def _united(found: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    out: list[tuple[int, int, str]] = []
    for begin, end, rule in sorted(found, key=lambda x: (x[0], -x[1])):
        if out and begin < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]), out[-1][2])
        else:
            out.append((begin, end, rule))
    return out


def _key_blocks(text: str):
    """Each opening mark of a private key to the next closing one; the text is read once."""
    at = 0
    while head := _BEGIN.search(text, at):
        tail = _END.search(text, head.end() + 1)
        if not tail:
            return
        at = tail.end()
        yield head.start(), at, "block"


def _names_credential(name: str) -> bool:
    return any(w in CREDENTIAL for w in _NAME.findall(name.lower()))


def candidates(text: str) -> list[tuple[int, int, str]]:
    found = list(_key_blocks(text)) if "PRIVATE KEY" in text else []
    if "=" in text or ":" in text:
        for m in _ASSIGNED.finditer(text):
            value = m["v"].rstrip("!.?:&$%#*")
            plain = value.isalpha() and value.islower()  # a word, unless it is called a password
            if len(value) >= 8 and (not plain or _names_credential(text[m.start() : m.start("v")])):
                found.append((m.start("v"), m.start("v") + len(value), "assignment"))
        found += [(*m.span("v"), "assignment") for m in _QUOTED.finditer(text) if _names_credential(m["n"])]
    for m in _RUN.finditer(text):
        if any(c.isdigit() for c in m[0]) or not m[0].isalpha():
            found.append((m.start(), m.end(), "run"))
    return _united(found)


def _coverage(value: str, words: frozenset[str]) -> float:
    """Share of the letters that the longest dictionary words cover, taken greedily from the left."""
    covered = letters = 0
    for run in _LETTERS.findall(value.lower()):
        letters += len(run)
        at = 0
        while at < len(run):
            size = next((n for n in range(min(16, len(run) - at), 2, -1) if run[at : at + n] in words), 0)
            covered += size
            at += size or 1
    return covered / letters if letters else 0.0


def features(text: str, begin: int, end: int, rule: str, language: Language) -> list[float]:
    value = text[begin:end]
    n = len(value)
    counts = Counter(value)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values())
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "s" for c in value]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:], strict=False)) / max(1, len(kinds) - 1)
    low = value.lower()
    steps = [language.pairs.get(low[i : i + 2], language.floor) for i in range(len(low) - 1) if low[i].isalpha() and low[i + 1].isalpha()]
    unseen = sum(s == language.floor for s in steps) / len(steps) if steps else 1.0
    before, after = text[max(0, begin - 60) : begin], text[end : end + 30]
    near = [w.lower() for w in _NAME.findall(before)][-4:]
    name = near[-2:]
    around = near + [w.lower() for w in _NAME.findall(after)][:2]
    return [
        float(n), entropy, changes, sum(steps) / len(steps) if steps else language.floor, unseen, _coverage(value, language.words),
        kinds.count("d") / len(kinds), kinds.count("u") / len(kinds), kinds.count("s") / len(kinds), float(bool(_HEX.match(value))),
        float(bool(_UUID.match(value))), float(value.count("/")), float(value.count(".")),
        float("/" in before[-2:] or "\\" in value or value.startswith(("/", "./", "~/"))), float("://" in value or "://" in before[-10:] or "@" in value),
        max(counts.values()) / n, float(any(w in CREDENTIAL for w in near)), float(any(w in CREDENTIAL for w in name)),
        float(any(w in DIGEST for w in near)), float(any(p in low for p in PLACEHOLDER) or any(w in PLACEHOLDER for w in around)),
        float(rule == "assignment" or bool(re.search(r"[=:]\W{0,4}\s?[\"']?$", before))), float(before[-1:] in ("'", '"')), float(rule == "block"),
        len(counts) / n,
    ]


def find(docs: DataFrame, language: Language, text: str = "text") -> DataFrame:
    """One row per candidate: the columns of ``docs`` but the text, and ``finding``."""

    @F.arrow_udf(f"array<{FINDING}>")
    def scan(column: pa.Array) -> pa.Array:
        out = []
        for body in column:
            body = body.as_py() or ""
            out.append([
                {"begin": b, "end": e, "rule": rule, "value": body[b:e], "features": features(body, b, e, rule, language)}
                for b, e, rule in candidates(body)
            ])
        return pa.array(out, _SHAPE)

    kept = [F.col(f"`{c}`") for c in docs.columns if c not in (text, "finding")]
    return docs.select(*kept, scan(F.col(text)).alias("findings")).select(*kept, F.explode("findings").alias("finding"))


def derived_findings(docs: DataFrame, text: str = "text", key: str = "doc_id", sample: int = 1500) -> DataFrame:
    """Labelled findings ``(text, begin, end, label)`` made from the words of at most ``sample`` whole documents."""
    whole = docs.filter(F.col(text).isNotNull()).select(F.col(key).cast("string").alias("k"), F.col(text).alias("t")).withColumn("x", F.xxhash64("t"))
    picked = smallest_by_hash(whole.select("k", "x").distinct(), sample, "k", "x", seed=6)
    # At most ``sample`` short rows are broadcast.
    same = F.col("k").eqNullSafe(F.col("pk")) & (F.col("x") == F.col("px"))
    chosen = whole.join(F.broadcast(picked.toDF("pk", "px")), same, "left_semi").dropDuplicates(["k", "x"]).select("k", "t")

    def build(batches):
        for batch in batches:
            rows = [made for k, t in zip(*(c.to_pylist() for c in batch.columns), strict=True) for made in invent(str(k), t)]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(
                [("text", pa.string()), ("begin", pa.int32()), ("end", pa.int32()), ("label", pa.float64())]))

    # One more row, so that there is something to learn from where there is no document.
    seed = docs.sparkSession.range(0, 1, 1, 1).select(F.lit("seed").alias("k"), F.lit("").alias("t"))
    return chosen.unionAll(seed).mapInArrow(build, "text string, begin int, end int, label double")


def invent(seed: str, text: str) -> list[dict]:
    """Labelled findings in contexts taken from ``text``, the same ones for the same seed."""
    rng = random.Random(int(hashlib.md5(seed.encode()).hexdigest()[:12], 16))
    words = _LETTERS.findall(text) or ["lorem", "ipsum", "dolor"]

    def chars(alphabet: str, low: int, high: int) -> str:
        return "".join(rng.choices(alphabet, k=rng.randint(low, high)))

    def some(n: int) -> list[str]:
        return rng.choices(words, k=n)

    alnum = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    hexes = lambda: "".join(rng.choices("0123456789abcdef", k=rng.choice([32, 40, 40, 64])))
    secret = [hexes, lambda: hexes().upper(), lambda: chars(alnum, 20, 48), lambda: chars(alnum + "+/", 24, 64) + rng.choice(["", "=", "=="]),
              lambda: chars(alnum + "!@#%^&*", 10, 24), lambda: f"{chars('abcdefgh', 2, 4)}_{chars(alnum, 24, 40)}"]
    joined = [lambda: rng.choice(["_", "-", ""]).join(some(rng.randint(2, 5))), lambda: "".join(w.capitalize() for w in some(4)),
              lambda: "/".join(some(rng.randint(2, 5))) + rng.choice(["", ".html", "/" + str(rng.randint(1, 999))])]
    harmless = [
        lambda: rng.choice(["xxxxxxxxxxxxxxxx", "your_token_here", "changeme123", "EXAMPLE_KEY_0000", "insert-secret-here", "dummy0123456789"]),
        lambda: rng.choice(some(1) + ["test"]) + "_" + rng.choice(["example", "placeholder", "sample123"]), *joined,
        lambda: rng.choice("0123456789x-_=") * rng.randint(16, 40), lambda: chars("0123456789", 12, 24),
    ]
    uuid = lambda: "-".join(chars("0123456789abcdef", k, k) for k in (8, 4, 4, 4, 12))
    credential = lambda: rng.choice(["", "api_", "access_", "client_", "db_"]) + rng.choice(["token", "secret", "password", "key", "auth_token", "passwd"])  # noqa: E731,E501
    digest = lambda: rng.choice(["sha256", "md5", "commit", "checksum", "etag", "digest", "revision", "build_id", "hash", "asset"])
    plan = [(1, credential, secret)] * 5 + [(0, digest, [hexes, hexes, uuid])] * 2 + [(0, credential, harmless)] * 2
    plan += [(0, lambda: rng.choice(some(1)), [*joined, *harmless[-2:]])] * 2 + [(0, None, [*joined, hexes, uuid, *harmless[-2:]])] * 2
    out = []
    for label, name, values in plan:
        value = rng.choice(values)()
        quote = rng.choice(['"', '"', "'", ""])
        noise = rng.choice(["", "", "", "!!", "###", "%%%"])
        if name is None:
            head = " ".join(some(3)) + f"{noise} "
        else:
            called = name() if rng.random() < 0.8 else name().upper()
            head = f"{' '.join(some(2))} {called}{noise}{rng.choice([' = ', '=', ': ', ' =' + noise + ' '])}{quote}"
        body = f"{head}{value}{quote if name else ''}{noise} {' '.join(some(3))}."
        out.append({"text": body, "begin": len(head), "end": len(head) + len(value), "label": float(label)})
    return out


def train(findings: DataFrame, language: Language, trees: int = 40, depth: int = 9, limit: int = 30000):
    """A forest from labelled findings, at most ``limit`` of them, in an order that every run repeats."""

    @F.arrow_udf("array<double>")
    def describe(text: pa.Array, begin: pa.Array, end: pa.Array) -> pa.Array:
        rows = zip(text.to_pylist(), begin.to_pylist(), end.to_pylist(), strict=True)
        return pa.array([features(t, b, e, _rule(t, b, e), language) for t, b, e in rows], pa.list_(pa.float64()))

    chosen = smallest_by_hash(findings, limit, "text", "begin", "end")
    vectors = chosen.select("label", array_to_vector(describe("text", "begin", "end")).alias("features"))
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=17, minInstancesPerNode=3, subsamplingRate=0.8).fit(vectors)


def _rule(text: str, begin: int, end: int) -> str:
    return next((rule for b, e, rule in candidates(text) if b < end and begin < e), "run")


def judge(found: DataFrame, forest, threshold: float = 0.5) -> DataFrame:
    """Findings with ``probability`` and ``is_secret``, without the features."""
    scored = forest.transform(found.withColumn("features", array_to_vector("finding.features")))
    kept = [F.col(f"`{c}`") for c in found.columns if c != "finding"]
    return scored.select(
        *kept, "finding.begin", "finding.end", "finding.rule", "finding.value", vector_to_array("probability")[1].alias("probability")
    ).withColumn("is_secret", F.col("probability") >= threshold)


def fit(docs: DataFrame, text: str = "text", key: str = "doc_id", findings: DataFrame | None = None):
    """The language and the forest; ``findings`` are labelled ones, made from ``docs`` where there are none."""
    language = learn_language(docs, text)
    return language, train(findings if findings is not None else derived_findings(docs, text, key), language)


def redact(docs: DataFrame, secrets: DataFrame, text: str = "text", mark: str = "<SECRET>") -> DataFrame:
    """``docs`` with the spans of ``secrets (doc_id, text_hash, begin, end)`` replaced; the rest is unchanged."""

    @F.arrow_udf("string")
    def replace(column: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for body, cuts in zip(column.to_pylist(), spans.to_pylist(), strict=True):
            for cut in sorted({(c["begin"], c["end"]) for c in cuts or []}, reverse=True):
                body = body[: cut[0]] + mark + body[cut[1] :]
            out.append(body)
        return pa.array(out, pa.string())

    spans = secrets.groupBy(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).agg(
        F.collect_set(F.struct("begin", "end")).alias("_spans")
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64(F.col(text)) == F.col("_hash"))
    joined = docs.join(spans, same, "left")
    changed = F.when(F.col("_spans").isNotNull(), replace(F.col(text), F.col("_spans"))).otherwise(F.col(text))
    return joined.withColumn(text, changed).select(*[F.col(f"`{c}`") for c in docs.columns])
