"""Secret scan: candidates by shape, false positives removed by a random forest.

1. Candidates are whole values, quoted or not and of any length, that are assigned to a credential word or stand as the password in
   user:password@host; and elsewhere runs of at least ``MIN_LENGTH`` characters of base64, hex or identifiers that hold a digit. Runs
   that single dots join are one candidate.
2. Its features: length, transitions between kinds of characters, shares of digits, capitals and hex digits, entropy, coverage by
   the dictionary, signs of a path around it, assignment, quotes, and the words next to it. The dictionary is the letter
   trigrams that stand out in the words of all documents.
3. Labelled findings train the forest: ``features``, ``label``. ``weak_findings`` labels those candidates on whose context and value
   two rules agree, and leaves the others open; at most ``sample`` of each label, by a hash, go to the driver.
4. Candidates that the forest gives at least ``least`` are secrets.

Everything happens in scans, nothing is shuffled but trigram counts and the sample. Null text has no candidates. Repeated rows are
scanned each for itself; offsets count characters; an empty table gives no rows; other columns are ignored. Without findings of both
labels the context alone decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subtide.llm import batch
from subtide.llm.shared import bounded, hash_sample, mapped, text_column, written

MIN_LENGTH = 16
AROUND = 80

# Words next to credentials and next to harmless strings.
CREDENTIAL_WORDS = frozenset("token secret password passwd pwd apikey api_key key auth authorization bearer credential credentials access_key private_key client_secret".split())
HARMLESS_WORDS = frozenset("commit sha sha1 sha256 md5 checksum digest hash uuid guid revision version etag example sample isbn id phone tel card number".split())

FEATURES = [
    "length", "transitions", "digits", "upper", "hex", "entropy", "dictionary", "separators", "path_before", "path_inside", "path_after", "assigned", "quoted", "credential_word", "harmless_word", "credential_distance"
]

_CANDIDATE = np.zeros(256, bool)
_CANDIDATE[list(b"+/_-")] = True
_CANDIDATE[48:58] = _CANDIDATE[65:91] = _CANDIDATE[97:123] = True
_KIND = np.zeros(256, np.int8)
_KIND[48:58], _KIND[65:91], _KIND[97:123] = 1, 2, 3
_HEX = np.zeros(256, bool)
_HEX[48:58] = _HEX[65:71] = _HEX[97:103] = True
_LETTER = batch.LOWER.astype(np.int64) - 97
_WORD = re.compile(rb"[A-Za-z_][A-Za-z0-9_]*")
_NAME = re.compile(rb"[A-Za-z0-9_]+$")
# An unquoted value ends at blanks, quotes and angle brackets, and at a separator before a blank or the next assignment.
_PLAIN = rb"(?:[^\s\"'`<>&,;]|[&,;](?!\s|$|[A-Za-z_][A-Za-z0-9_.-]*=))+"
_VALUE = re.compile(
    rb"(?::=|=>|==|[:=])[ \t]*(?:(?:bearer|basic)[ \t]+)?(?:\"((?:[^\"\\\n]|\\[^\n])+)\"|'((?:[^'\\\n]|\\[^\n])+)'|`([^`\n]+)`|[\"'`]?(" + _PLAIN + rb"))", re.IGNORECASE
)
_URL_PASSWORD = re.compile(rb"://[^\s/?#:@\"'`<>]*:([^\s/?#\"'`<>]+)@(?=[A-Za-z0-9\[])")
_PASSWORD = re.compile(rb":([^\s/?#:@\"'`<>]+)@(?=[A-Za-z0-9\[])")
_ENDS = {41: b"(", 93: b"[", 125: b"{"}
TRIGRAMS = 26**3


def trigrams(data: np.ndarray) -> np.ndarray:
    """Number of the ASCII letter trigram at each place, -1 where there is none."""
    if len(data) < 3:
        return np.zeros(0, np.int64)
    code = _LETTER[data]
    a, b, c = code[:-2], code[1:-1], code[2:]
    letters = (a >= 0) & (a < 26) & (b >= 0) & (b < 26) & (c >= 0) & (c < 26)
    return np.where(letters, (a * 26 + b) * 26 + c, -1)


def trigram_dictionary(docs: DataFrame) -> np.ndarray:
    """Which trigrams are commoner than the mean trigram, by counts over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(TRIGRAMS, np.int64)
        for rows in batches:
            for _, data, _ in batch.runs(rows.column(0)):
                own = trigrams(data)
                totals += np.bincount(own[own >= 0], minlength=TRIGRAMS)
        at = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(totals[at], pa.int64())], names=["trigram", "n"])

    counts = np.zeros(TRIGRAMS)
    summed = bounded(docs).select(text_column("text").alias("text")).mapInArrow(count, "trigram int, n long").groupBy("trigram").agg(F.sum("n").alias("n"))
    for row in summed.collect():  # at most 26 ** 3 rows
        counts[row["trigram"]] = row["n"]
    return counts > counts.mean()


def _credential(before: bytes) -> bool:
    """Whether the name that ends here is a credential word, or one with a prefix."""
    name = _NAME.search(before[-AROUND:].rstrip(b" \t\"'`"))
    if not name:
        return False
    word = name.group().lower().decode()
    return word in CREDENTIAL_WORDS or any(word.endswith(f"_{w}") for w in CREDENTIAL_WORDS)


def assigned_values(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, bool]]:
    """(row, start, end, credential) of the values of credential words and the passwords before @, in order and apart from each other.

    ``credential`` is false for a password before @ that is not in a URL: its context does not say what it is.
    """
    raw = data.tobytes()
    out, done = [], 0
    signs = np.flatnonzero((data == 58) | (data == 61))
    rows = np.searchsorted(offsets, signs, "right") - 1
    for at, row in zip(signs.tolist(), rows.tolist(), strict=True):
        if at < done:
            continue
        low, high = int(offsets[row]), int(offsets[row + 1])
        credential = True
        if _credential(raw[max(low, at - AROUND) : at]) and (found := _VALUE.match(raw, at, high)):
            start, end = found.span(found.lastindex)
            while found.lastindex == 4 and end > start and (raw[end - 1] in b".,;:" or (raw[end - 1] in _ENDS and _ENDS[raw[end - 1]] not in raw[start:end])):
                end -= 1
        elif raw.startswith(b"://", at) and (found := _URL_PASSWORD.match(raw, at, high)):
            start, end = found.span(1)
        elif at > low and _NAME.search(raw[at - 1 : at]) and (found := _PASSWORD.match(raw, at, high)):
            start, end, credential = *found.span(1), False
        else:
            continue
        if end > start:
            out.append((row, start, end, credential))
            done = end
    return out


def _candidate_features(data: np.ndarray, row: tuple[int, int], span: tuple[int, int], dictionary: np.ndarray, credential: bool | None = None) -> list[float]:
    """``credential`` says what is known of a value that ``assigned_values`` found; it is not part of a path then."""
    start, end = span
    own = data[start:end]
    n = len(own)
    kinds = _KIND[own]
    counts = np.bincount(own, minlength=256)
    share = counts[counts > 0] / n
    known = trigrams(own)
    common = np.flatnonzero((known >= 0) & dictionary[known])
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[common + k] = True
    before = data[max(row[0], start - AROUND) : start].tobytes()
    after = data[end : min(row[1], end + AROUND)].tobytes()
    near = before.rstrip(b"\"'` ")
    assigned = near.endswith((b"=", b":", b"=>"))
    words_before = [w.lower().decode() for w in _WORD.findall(before)][::-1][:4]
    login = credential is not None and after[:1] == b"@"
    words_after = [] if login else [w.lower().decode() for w in _WORD.findall(after)][:2]  # a host's name says nothing
    distance = 0 if credential else next((k for k, w in enumerate(words_before) if w in CREDENTIAL_WORDS), 9)
    around = {*words_before, *words_after}
    credential_word = bool(credential or around & CREDENTIAL_WORDS)
    path_after = after[:1] in (b".", b"@", b":", b"\\") and not login
    assigned = assigned or credential is not None
    return [
        n, float((kinds[1:] != kinds[:-1]).sum()) / max(1, n - 1), float((kinds == 1).mean()), float((kinds == 2).mean()), float(_HEX[own].mean()), float(-(share * np.log2(share)).sum()),
        float(covered.mean()), float((kinds == 0).mean()), float(before[-1:] in (b"/", b".", b"@", b"\\")), float((own == 47).sum()), float(path_after), float(assigned),
        float(before[-1:] in (b'"', b"'", b"`") and after[:1] == before[-1:]), float(credential_word), float(bool(around & HARMLESS_WORDS)), float(distance),
    ]


def candidates(data: np.ndarray, offsets: np.ndarray, dictionary: np.ndarray) -> Iterator[tuple[int, int, int, list[float]]]:
    """(row, start, end, features) of the candidates of a run, in bytes of the run."""
    found = batch.words(data, offsets, lower=False, inside=_CANDIDATE)
    digits = np.concatenate([[0], np.cumsum(_KIND[data] == 1)])
    long = np.flatnonzero(found.ends - found.starts >= MIN_LENGTH)
    starts, ends = found.starts[long], found.ends[long]
    rows = np.searchsorted(offsets, starts, "right") - 1
    # Neighbours that a single dot joins are one.
    joined = (starts[1:] - ends[:-1] == 1) & (rows[1:] == rows[:-1]) & (data[np.minimum(ends[:-1], max(0, len(data) - 1))] == 46)
    first = np.concatenate([np.ones(min(1, len(long)), bool), ~joined])
    starts, rows, ends = starts[first], rows[first], ends[np.concatenate([~joined, np.ones(min(1, len(long)), bool)])]
    values = assigned_values(data, offsets)
    # A run that shares bytes with a value is part of it.
    value_starts, value_ends = np.array([v[1] for v in values], np.int64), np.array([v[2] for v in values], np.int64)
    free = np.searchsorted(value_ends, starts, "right") == np.searchsorted(value_starts, ends, "left")
    free &= digits[ends] > digits[starts]
    every = [(row, start, end, None) for row, start, end in zip(rows[free].tolist(), starts[free].tolist(), ends[free].tolist(), strict=True)]
    for row, start, end, credential in sorted(values + every, key=lambda x: x[1]):
        yield row, start, end, _candidate_features(data, (int(offsets[row]), int(offsets[row + 1])), (start, end), dictionary, credential)


def weak_label(features: list[float]) -> int | None:
    """1 if context and value both speak for a secret, 0 if both speak against one, else None."""
    f = dict(zip(FEATURES, features, strict=True))
    context = f["assigned"] and f["credential_distance"] <= 1 and not f["harmless_word"]
    # A short value cannot reach the entropy of a long one; it is random if it mixes digits with others.
    mixed = f["length"] >= 6 and f["digits"] > 0 and f["entropy"] >= 0.85 * np.log2(f["length"])
    random = (f["entropy"] >= 3 or mixed) and f["dictionary"] < 0.5 and f["digits"] < 1 and f["separators"] < 0.5
    path = f["path_before"] or f["path_inside"] > 1 or f["path_after"]
    if context and random and not path:
        return 1
    # What follows a colon in prose: a word or a sentence, not a value.
    word = f["digits"] == 0 and f["upper"] * f["length"] <= 1 and (f["dictionary"] >= 0.5 or f["length"] < 4) and (f["length"] < MIN_LENGTH or f["separators"] > 0.05)
    if context and word:
        return 0
    if not f["credential_word"] and (path or f["dictionary"] >= 0.6 or f["digits"] == 1 or f["harmless_word"]):
        return 0
    return None


@dataclass
class Forest:
    """Trees as arrays: feature (-1: leaf), threshold, left and right child, share of secrets."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    def predict(self, x: np.ndarray) -> np.ndarray:
        if not self.trees:
            distance, assigned = FEATURES.index("credential_distance"), FEATURES.index("assigned")
            return ((x[:, distance] <= 1) & (x[:, assigned] > 0)).astype(float)
        total = np.zeros(len(x))
        for feature, threshold, left, right, share in self.trees:
            at = np.zeros(len(x), np.int64)
            while (inner := feature[at] >= 0).any():
                own = np.flatnonzero(inner)
                node = at[own]
                at[own] = np.where(x[own, feature[node]] <= threshold[node], left[node], right[node])
            total += share[at]
        return total / len(self.trees)


def fit_forest(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 8, leaf: int = 3, bins: int = 32, seed: int = 11) -> Forest:
    """Bagged trees, each split over a random third of the features at quantile thresholds by Gini impurity."""
    if len(set(y.tolist())) < 2:
        return Forest([])
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.column_stack([np.searchsorted(e, c, "left") for e, c in zip(cuts, x.T, strict=True)])
    tried = max(1, x.shape[1] // 3)
    # Both labels weigh the same.
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum()) * len(y)
    out = []
    for _ in range(trees):
        nodes: list[list[float]] = []

        def grow(rows: np.ndarray, level: int) -> int:
            here = len(nodes)
            total, secret = weight[rows].sum(), (weight[rows] * y[rows]).sum()
            nodes.append([-1, 0.0, 0, 0, secret / total])
            if level == depth or len(rows) < 2 * leaf or secret <= 0 or secret >= total:
                return here
            best = (2 * secret * (total - secret) / total - 1e-9, -1, -1)
            for f in rng.choice(x.shape[1], tried, replace=False):
                size = len(cuts[f]) + 1
                n = np.cumsum(np.bincount(binned[rows, f], minlength=size))[:-1]
                w = np.cumsum(np.bincount(binned[rows, f], weight[rows], size))[:-1]
                s = np.cumsum(np.bincount(binned[rows, f], weight[rows] * y[rows], size))[:-1]
                fits = (n >= leaf) & (len(rows) - n >= leaf)
                if fits.any():
                    with np.errstate(divide="ignore", invalid="ignore"):
                        impurity = np.where(fits, 2 * s * (w - s) / w + 2 * (secret - s) * (total - w - secret + s) / (total - w), np.inf)
                    k = int(np.argmin(impurity))
                    if impurity[k] < best[0]:
                        best = (float(impurity[k]), int(f), k)
            _, f, k = best
            if f < 0:
                return here
            below = binned[rows, f] <= k
            nodes[here][:2] = [f, float(cuts[f][k])]
            nodes[here][2] = grow(rows[below], level + 1)
            nodes[here][3] = grow(rows[~below], level + 1)
            return here

        grow(rng.integers(0, len(y), len(y)), 0)
        table = np.array(nodes)
        out.append((table[:, 0].astype(int), table[:, 1], table[:, 2].astype(int), table[:, 3].astype(int), table[:, 4]))
    return Forest(out)


def weak_findings(docs: DataFrame, dictionary: np.ndarray) -> DataFrame:
    """features and label of the candidates that both rules label alike."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out = []
            for _, data, offsets in batch.runs(rows.column(0)):
                for _, _, _, features in candidates(data, offsets, dictionary):
                    label = weak_label(features)
                    if label is not None:
                        out.append((features, label))
            yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in out], pa.list_(pa.float64())), pa.array([k for _, k in out], pa.int32())], names=["features", "label"])

    return docs.select(text_column("text").alias("text")).mapInArrow(emit, "features array<double>, label int")


def train_forest(findings: DataFrame, sample: int = 5_000) -> Forest:
    """A forest of labelled findings, at most ``sample`` of each label by a hash of their features."""
    findings = written(findings.select("features", "label"), "findings")
    totals = {r["label"]: r["count"] for r in findings.groupBy("label").count().collect()}
    rows = []
    for label in (0, 1):
        rows += hash_sample(findings.where(F.col("label") == label), F.col("features"), sample, totals.get(label, 0))
    return fit_forest(np.array([r["features"] for r in rows]).reshape(-1, len(FEATURES)), np.array([r["label"] for r in rows], np.int64))


def scored_candidates(docs: DataFrame, forest: Forest, dictionary: np.ndarray, least: float = 0.5) -> DataFrame:
    """One row per candidate: doc_id, start, length (characters), value, score, secret."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("value", pa.string()), ("score", pa.float64()), ("secret", pa.bool_())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for first, data, offsets in batch.runs(rows.column(1)):
                found = list(candidates(data, offsets, dictionary))
                chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                scores = forest.predict(np.array([f for *_, f in found]).reshape(-1, len(FEATURES)))
                out = [
                    (rows.column(0)[first + row].as_py(), int(chars[start] - chars[offsets[row]]), int(chars[end] - chars[start]), data[start:end].tobytes().decode(), round(float(score), 9), bool(score >= least))
                    for (row, start, end, _), score in zip(found, scores, strict=True)
                ]
                columns = list(zip(*out, strict=True)) or [()] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column("text").alias("text"))
    return texts.mapInArrow(emit, "doc_id long, start long, length long, value string, score double, secret boolean")


def secret_scan(docs: DataFrame, findings: DataFrame | None = None, least: float = 0.5) -> DataFrame:
    """Candidates of all documents, scored by a forest that ``findings`` (default: weakly labelled ones of these documents) trained."""
    dictionary = trigram_dictionary(docs)
    forest = train_forest(weak_findings(docs, dictionary) if findings is None else findings)
    return scored_candidates(docs, forest, dictionary, least)


def without_secrets(docs: DataFrame, mark: str = "[SECRET]", findings: DataFrame | None = None, least: float = 0.5) -> DataFrame:
    """``docs`` with every secret in its text replaced by a mark; n_chars, if there is one, is counted anew."""
    dictionary = trigram_dictionary(docs)
    forest = train_forest(weak_findings(docs, dictionary) if findings is None else findings)
    names = docs.columns
    at = names.index("text")

    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts: dict[int, list[tuple[int, int]]] = {}
            whole = rows.column(at)
            changed = {}
            for first, data, offsets in batch.runs(whole):
                found = list(candidates(data, offsets, dictionary))
                scores = forest.predict(np.array([f for *_, f in found]).reshape(-1, len(FEATURES)))
                texts = {}
                for (row, start, end, _), score in zip(found, scores, strict=True):
                    if score >= least:
                        texts.setdefault(row, []).append((start, end))
                for row, spans in texts.items():
                    own, place = [], int(offsets[row])
                    for start, end in spans:
                        own += [data[place:start].tobytes(), mark.encode()]
                        place = end
                    own.append(data[place : offsets[row + 1]].tobytes())
                    changed[first + row] = b"".join(own).decode()
            if changed:
                values = whole.to_pylist()
                for row, text in changed.items():
                    values[row] = text
                columns = [*rows.columns]
                columns[at] = pa.array(values, whole.type)
                rows = pa.RecordBatch.from_arrays(columns, names=rows.schema.names)
            yield rows

    redacted = mapped(docs, redact, docs.schema)
    return redacted.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in names else redacted
