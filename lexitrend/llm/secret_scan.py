"""Secret scans: three base rules, and a character convolutional network over every other candidate.

Base rules are leftmost, non-overlapping regular expressions.  A candidate is what these leave
of a maximal run of 16 or more token characters: each piece of 16 or more.
The network reads it with the characters around it; of a piece longer than it can read, it reads
overlapping windows, and the best one decides.  It is trained on labelled findings: of the corpus,
all different candidates that a base rule covers against all that none covers, and generated
ones, tokens of further shapes against look-alikes (``secret_shapes``), with contexts swapped between
findings so that it has to read the token itself.  The corpus's findings are dealt into shards; each
round trains the network on every shard and takes the mean of the weights.  Its output is calibrated on
held-back findings, and the threshold is the highest one that keeps the asked recall there for every shape.  Candidates that reach
it are added as spans of kind ``model``; base spans always stay.

Defined results: null text has no spans; offsets are code points, end exclusive; repeated
rows are scanned one by one; extra columns are not read; an empty table gives an empty
result, with a network of the generated findings alone.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quantiles import exact_percentiles
from .common import ready, schema, texts, whole_row, written
from .secret_shapes import LOOK_ALIKES, SHAPES, findings

#: What the corpus's findings of either class weigh together in a shard, at most, whatever their number.
CLASS_WEIGHT = 1500
#: Findings in a shard, and shards (their networks, about 30 KB each, meet on the driver); passes over the
#: findings of one shard, and of many, by round.
SHARD, MOST_SHARDS = 20_000, 64
EPOCHS, ROUNDS = 14, (3, 3, 3)
#: Generated lines of each shape and of each kind of look-alike.
LINES_PER_SHAPE = 160
RECALL = 0.98
MASK = b"[SECRET]"
BEFORE, HEAD, TAIL, AFTER = 24, 28, 12, 24
WIDTH = BEFORE + HEAD + TAIL + AFTER
#: Views that the network reads at once.
VIEWS = 1 << 16


def _either(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


ASSIGN = re.compile(("(" + "|".join(map(_either, ("password", "passwd", "secret", "token", "api_?key")))
                     + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""").encode())
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]+")
RUN = re.compile(rb"[A-Za-z0-9+/_.=-]{16,}")
KINDS = ("assign", "access", "hex", "model")


def base_spans(b: bytes) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """((start, kind, end) of the base rules, candidate runs), in bytes.

    Access keys and hex strings of the asked lengths only occur inside runs of 16 token
    characters, so one search finds the runs and the two rules search those."""
    found, runs = [], []
    low = b.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(b) if m.end(2) - m.start(2) >= 8]
    for r in RUN.finditer(b):
        s, e = r.span()
        if b.find(b"AKIA", s, e) >= 0:
            found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(b, s, e) if m.end() - m.start() >= 16]
        runs.append((s, e))
        if e - s >= 32:
            found += [(m.start(), 2, m.end()) for m in HEX.finditer(b, s, e) if m.end() - m.start() >= 32]
    return sorted(found), runs


def covered(spans: list[tuple[int, int, int]], s: int, e: int) -> bool:
    return any(a < e and s < z for a, _, z in spans)


def rest(spans: list[tuple[int, int, int]], s: int, e: int) -> list[tuple[int, int]]:
    """The pieces of a run that no span covers, of 16 bytes or more."""
    out = []
    for a, _, z in [*spans, (e, 0, e)]:
        if a - s >= 16 and a <= e:
            out.append((s, a))
        if a < e:
            s = max(s, min(z, e))
    return out


def windows(s: int, e: int) -> list[tuple[int, int]]:
    """A candidate, and if it is longer than a view reads, overlapping parts that are read whole."""
    size = HEAD + TAIL
    if e - s <= size:
        return [(s, e)]
    return [(s, e), *((k, k + size) for k in [*range(s, e - size, size // 2), e - size])]


def view(b: bytes, s: int, e: int) -> bytes:
    """The candidate's first and last characters between its surroundings, WIDTH bytes, 0 where none."""
    before = b[max(0, s - BEFORE):s].rjust(BEFORE, b"\0")
    token = b[s:min(e, s + HEAD)].ljust(HEAD, b"\0") + b[max(s + HEAD, e - TAIL):e].ljust(TAIL, b"\0")
    return before + token + b[e:e + AFTER].ljust(AFTER, b"\0")


@dataclass
class Network:
    """Embedding, one convolution, maxima over positions, one logistic unit."""
    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    slope: float = 1.0
    shift: float = 0.0
    cut: float = 0.5

    SPAN = 5

    def _columns(self, codes: np.ndarray) -> np.ndarray:
        x = self.embed[codes]
        mark = np.zeros((len(codes), WIDTH, 1), dtype=x.dtype)
        mark[:, BEFORE:BEFORE + HEAD + TAIL] = 1
        x = np.concatenate([x, mark], axis=2)
        return np.concatenate([x[:, k:WIDTH - self.SPAN + 1 + k] for k in range(self.SPAN)], axis=2)

    def logit(self, codes: np.ndarray) -> np.ndarray:
        done = [np.zeros(0)]
        for k in range(0, len(codes), 512):
            a = np.maximum(self._columns(codes[k:k + 512]) @ self.filters + self.bias, 0)
            done.append(a.max(axis=1) @ self.out + self.out_bias)
        return np.concatenate(done)

    def probability(self, codes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.logit(codes) + self.shift, -30, 30)))


WEIGHTS = ("embed", "filters", "bias", "out", "out_bias")


def fresh(n_filters: int = 32, dims: int = 8, seed: int = 0) -> Network:
    rng = np.random.default_rng(seed)
    cols = (dims + 1) * Network.SPAN
    return Network(rng.normal(0, 0.3, (256, dims)), rng.normal(0, (2 / cols) ** 0.5, (cols, n_filters)),
                   np.zeros(n_filters), rng.normal(0, 0.3, n_filters), np.zeros(1))


def train(codes: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, rate: float = 0.01, batch: int = 64, seed: int = 0,
          weight: np.ndarray | None = None, start: Network | None = None) -> Network:
    """Adam on the (weighted) logistic loss, from ``start`` on; half of each batch gets the surroundings of
    another sample."""
    rng = np.random.default_rng(seed)
    net = fresh() if start is None else replace(start)
    n_filters, dims = len(net.bias), net.embed.shape[1]
    weight = np.ones(len(y)) if weight is None else weight
    names = WEIGHTS
    m = {n: np.zeros_like(getattr(net, n)) for n in names}
    v = {n: np.zeros_like(getattr(net, n)) for n in names}
    around = np.r_[0:BEFORE, BEFORE + HEAD + TAIL:WIDTH]
    step = 0
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(len(y)), max(1, len(y) // batch)):
            c = codes[at].copy()
            swap = rng.random(len(at)) < 0.5
            c[np.ix_(swap, around)] = codes[rng.integers(0, len(y), swap.sum())][:, around]
            x = net._columns(c)
            a = np.maximum(x @ net.filters + net.bias, 0)
            top = a.argmax(axis=1)
            pooled = np.take_along_axis(a, top[:, None, :], axis=1)[:, 0]
            p = 1 / (1 + np.exp(-np.clip(pooled @ net.out + net.out_bias, -30, 30)))
            err = (p - y[at]) * weight[at] / len(at)
            dpool = err[:, None] * net.out * (pooled > 0)
            picked = x[np.arange(len(at))[:, None], top]  # (rows, filters, columns)
            grads = {"out": pooled.T @ err, "out_bias": np.array([err.sum()]), "bias": dpool.sum(axis=0),
                     "filters": np.einsum("rf,rfc->cf", dpool, picked), "embed": np.zeros_like(net.embed)}
            dx = (dpool[:, :, None] * net.filters.T[None]).reshape(len(at), n_filters, Network.SPAN, dims + 1)
            for k in range(Network.SPAN):
                np.add.at(grads["embed"], c[np.arange(len(at))[:, None], top + k], dx[:, :, k, :dims])
            step += 1
            for n in names:
                m[n] = 0.9 * m[n] + 0.1 * grads[n]
                v[n] = 0.999 * v[n] + 0.001 * grads[n] ** 2
                now = m[n] / (1 - 0.9 ** step) / (np.sqrt(v[n] / (1 - 0.999 ** step)) + 1e-8)
                setattr(net, n, getattr(net, n) - rate * now)
    return net


def calibrate(net: Network, codes: np.ndarray, y: np.ndarray, recall: float = RECALL, shape: np.ndarray | None = None) -> None:
    """Platt scaling with smoothed targets, then the highest threshold that keeps ``recall`` of every shape."""
    z = net.logit(codes)
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-9)
        grad = np.array([((p - target) * z).sum() + 1e-3 * (a - 1), (p - target).sum()])
        hess = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-9]])
        d = np.linalg.solve(hess, grad)
        d *= min(1.0, 2 / max(np.abs(d).max(), 1e-12))
        a, b = a - d[0], b - d[1]
    net.slope, net.shift = float(a), float(b)
    good = net.probability(codes[y == 1])
    of = shape[y == 1] if shape is not None else np.zeros(len(good), np.int64)
    net.cut = min((float(np.quantile(good[of == k], 1 - recall, method="lower")) for k in np.unique(of)), default=0.5)


def generated(shapes: dict, n: int, seed: int) -> list[tuple[str, bytes]]:
    """(shape, view) of the candidates in generated lines that a scan would read for their token."""
    out = []
    for name, line, start, end in findings(shapes, n, seed):
        b = line.encode()
        found, runs = base_spans(b)
        for s, e in runs:
            for a, z in rest(found, s, e):
                # of a long candidate the windows that hold nothing but the token, or the token whole
                out += [(name, view(b, p, q)) for p, q in windows(a, z)
                        if (start <= p and q <= end) or (p <= start and end <= q)]
    return out


def codes_of(views: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(views), dtype=np.uint8).reshape(-1, WIDTH)


def labelled_findings(docs: DataFrame) -> DataFrame:
    """(seen, label, held): every different view of a candidate run, whether a base rule covers it, and
    whether it belongs to the quarter that is held back."""
    def run(batches):
        for b in batches:
            seen, label = [], []
            for t in texts(b.column(0)):
                found, runs = base_spans(t)
                for s, e in runs:
                    seen.append(view(t, s, e))
                    label.append(int(covered(found, s, e)))
            yield pa.RecordBatch.from_arrays([pa.array(seen, pa.binary()), pa.array(label, pa.int32())],
                                             ["seen", "label"])

    all_seen = docs.select(F.col("text").cast("string")).mapInArrow(run, "seen binary, label int").distinct()
    held = F.pmod(F.xxhash64("seen", F.lit("held")), F.lit(4)) == 3
    return written(docs.sparkSession, all_seen.withColumn("held", held), "secret-findings")


def train_on_shards(rows: DataFrame, number: dict[int, int], codes: np.ndarray, y: np.ndarray) -> Network:
    """The network trained on all ``rows`` (seen, label) and, in each shard, on the generated findings
    (``codes``, ``y``): a round trains it shard by shard and takes the mean, weighted by their findings."""
    shards = min(MOST_SHARDS, max(1, -(-sum(number.values()) // SHARD)))
    share = {k: min(1.0, CLASS_WEIGHT * shards / n) for k, n in number.items()}
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("seen", F.lit("shard")), F.lit(shards)))

    def on_shard(net: Network, epochs: int, seed: int):
        def run(t: pa.Table) -> pa.Table:
            t = t.sort_by([("label", "ascending"), ("seen", "ascending")])
            label = t.column("label").to_numpy()
            weight = np.r_[[share[x] for x in label.tolist()], np.ones(len(y))]
            now = train(np.r_[codes_of(t.column("seen").to_pylist()), codes], np.r_[label, y], epochs, seed=seed,
                        weight=weight, start=net)
            flat = np.concatenate([getattr(now, n).ravel() for n in WEIGHTS])
            return pa.table([t.column("shard")[:1], pa.array([len(label)], pa.int64()), pa.array([flat.tobytes()], pa.binary())],
                            ["shard", "n", "net"])
        return run

    net = fresh()
    for k, epochs in enumerate((EPOCHS,) if shards == 1 else ROUNDS):
        done = sorted(dealt.groupBy("shard").applyInArrow(on_shard(net, epochs, k), "shard long, n long, net binary").collect())
        if not done:  # no finding of the corpus
            return train(codes, y)
        mean = np.average([np.frombuffer(r["net"]) for r in done], axis=0, weights=[r["n"] for r in done])
        ends = np.cumsum([getattr(net, n).size for n in WEIGHTS])
        net = Network(*(x.reshape(getattr(net, n).shape) for n, x in zip(WEIGHTS, np.split(mean, ends[:-1]), strict=True)))
    return net


def calibrate_all(net: Network, rows: DataFrame, number: dict[int, int], codes: np.ndarray, y: np.ndarray,
                  shape: np.ndarray, recall: float = RECALL) -> None:
    """``calibrate`` over all held-back findings of the corpus, ``rows`` (seen, label), and the generated ones."""
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(net.logit(codes_of(b.column(0).to_pylist())))],
                                             ["label", "z"])

    calibrate(net, codes, y, recall, shape)
    if not sum(number.values()):
        return
    at = written(rows.sparkSession, rows.select("seen", "label").mapInArrow(run, "label int, z double"), "secret-logits")
    share = {k: min(1.0, CLASS_WEIGHT / n) for k, n in number.items()}
    n1, n0 = (sum(y == k) + share.get(k, 0) * number.get(k, 0) for k in (1, 0))
    high, low = float((n1 + 1) / (n1 + 2)), float(1 / (n0 + 2))
    z, c = net.logit(codes), F.col("z")
    is_1 = F.col("label") == 1
    v, t = (F.when(is_1, F.lit(float(one))).otherwise(F.lit(float(other)))
            for one, other in ((share.get(1, 0), share.get(0, 0)), (high, low)))
    a, b = 1.0, 0.0
    for _ in range(25):  # Newton's steps of Platt scaling: sums over the corpus in Spark, over the generated here
        p = 1 / (1 + F.exp(-F.greatest(F.least(F.lit(a) * c + F.lit(b), F.lit(30.0)), F.lit(-30.0))))
        w = F.greatest(p * (1 - p), F.lit(1e-9))
        of = at.agg(*[F.sum(v * x) for x in ((p - t) * c, p - t, w * c * c, w * c, w)]).first()
        q = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        u, off = np.maximum(q * (1 - q), 1e-9), q - np.where(y == 1, high, low)
        g0, g1, h0, h1, h2 = (r + x.sum() for r, x in zip(of, (off * z, off, u * z * z, u * z, u), strict=True))
        d = np.linalg.solve(np.array([[h0 + 1e-3, h1], [h1, h2 + 1e-9]]), np.array([g0 + 1e-3 * (a - 1), g1]))
        d *= min(1.0, 2 / max(np.abs(d).max(), 1e-12))
        a, b = float(a - d[0]), float(b - d[1])
        if np.abs(d).max() < 1e-6:
            break
    net.slope, net.shift = a, b
    good = net.probability(codes[y == 1])
    least = [float(np.quantile(good[shape[y == 1] == k], 1 - recall, method="lower")) for k in np.unique(shape[y == 1])]
    if number.get(1):
        last = max(number[1] - 1, 1)
        kept = exact_percentiles(at.where(is_1), [], "z", [int((1 - recall) * last) / last]).first()["q"][0] - 1e-9
        least.append(float(1 / (1 + np.exp(-np.clip(a * kept + b, -30, 30)))))
    net.cut = min(least, default=0.5)


def fit(docs: DataFrame, recall: float = RECALL) -> Network:
    """A network trained on all different findings of the corpus and on the generated ones; a quarter of
    both is held back for calibration and threshold."""
    ready(docs.sparkSession)
    rows = labelled_findings(docs)
    number = {(r["label"], r["held"]): r["count"] for r in rows.groupBy("label", "held").count().collect()}
    samples = [(1, *x) for x in generated(SHAPES, LINES_PER_SHAPE, 1)]
    samples += [(0, *x) for x in generated(LOOK_ALIKES, LINES_PER_SHAPE, 2)]
    y = np.array([x[0] for x in samples])
    shape = np.unique([x[1] for x in samples], return_inverse=True)[1]
    codes = codes_of([x[2] for x in samples])
    held = np.arange(len(y)) % 4 == 3
    of = {h: {k: n for (k, x), n in number.items() if x == h} for h in (False, True)}
    net = train_on_shards(rows.where(~F.col("held")), of[False], codes[~held], y[~held])
    calibrate_all(net, rows.where("held"), of[True], codes[held], y[held], shape[held], recall)
    return net


def scan(batch: list[bytes], net: Network | None) -> list[list[tuple[int, int, int]]]:
    """All spans (start, kind, end) in bytes of each text, sorted."""
    out, views, where = [], [], []

    def read():
        p = net.probability(np.frombuffer(b"".join(views), dtype=np.uint8).reshape(-1, WIDTH))
        for k, s, e in {w: None for w, ok in zip(where, p >= net.cut, strict=True) if ok}:
            if (s, 3, e) not in out[k][-1:]:  # windows of one candidate may be read in two turns
                out[k].append((s, 3, e))
        views.clear()
        where.clear()

    for k, t in enumerate(batch):
        found, runs = base_spans(t)
        out.append(found)
        if net is not None:
            for s, e in runs:
                near = [x for x in found if x[0] < e and s < x[2]]
                for a, z in rest(near, s, e) if near else [(s, e)]:
                    parts = windows(a, z)
                    views += [view(t, *w) for w in parts]
                    where += [(k, a, z)] * len(parts)
                    if len(views) >= VIEWS:
                        read()
    if views:
        read()
    return [sorted(x) for x in out]


def code_points(t: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The same spans in code points."""
    if t.isascii():
        return spans
    return [(len(t[:s].decode()), k, len(t[:s].decode()) + len(t[s:e].decode())) for s, k, e in spans]


def find_secrets(docs: DataFrame, net: Network | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, one count per kind, base_spans and spans (kind:start:end, comma-joined), per row."""
    ready(docs.sparkSession)

    def run(batches):
        for b in batches:
            batch = texts(b.column(1))
            rows = [code_points(t, x) for t, x in zip(batch, scan(batch, net), strict=True)]
            said = [[(k, f"{KINDS[k]}:{s}:{e}") for s, k, e in x] for x in rows]
            cols = [b.column(0)] + [pa.array([sum(k == n for _, k, _ in x) for x in rows], pa.int64()) for n in range(4)]
            cols.append(pa.array([",".join(w for k, w in x if k < 3) for x in said], pa.string()))
            cols.append(pa.array([",".join(w for _, w in x) for x in said], pa.string()))
            yield pa.RecordBatch.from_arrays(cols, ["key", *(f"n_{n}" for n in KINDS), "base_spans", "spans"])

    kinds = schema(("key", docs.schema[key].dataType),
                   ", ".join(f"n_{n} long" for n in KINDS) + ", base_spans string, spans string")
    return docs.select(F.col(key), F.col(text).cast("string")).mapInArrow(run, kinds).withColumnRenamed("key", key)


def redact(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """``docs`` with every span of its text replaced by MASK; texts without spans, and all other
    columns, are as they were (n_chars, where there is one, counts the new text)."""
    ready(docs.sparkSession)
    rows = docs.select(whole_row(docs), F.col(text).cast("string"))

    def run(batches):
        for b in batches:
            batch = texts(b.column(1))
            new = []
            for t, spans in zip(batch, scan(batch, net), strict=True):
                done, at = [], 0
                for s, _, e in spans:
                    if e > at:
                        if s >= at:
                            done += [t[at:s], MASK]
                        at = e
                new.append((b"".join(done) + t[at:]).decode() if spans else None)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(new, pa.string())], ["row", "new"])

    out = rows.mapInArrow(run, schema(("row", rows.schema["row"].dataType), "new string"))
    cols = [F.coalesce("new", f"row.`{c}`").alias(c) if c == text
            else F.when(F.col("new").isNull(), F.col(f"row.`{c}`")).otherwise(F.length("new").cast("long")).alias(c)
            if c == "n_chars" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return out.select(*cols)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.tables import table
    docs = table(spark, sf_dir, "documents")
    found = find_secrets(docs, fit(docs))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"),
                        "spans", "n_model")
