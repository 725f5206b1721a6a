"""Operator 4: secret scan with corpus-wide ownership frequency.

Every whole text is scanned once for candidates.  *Base* candidates (assigned
passwords and tokens, access keys, long hexadecimal strings) are always
reported.  *Method* candidates (issued-token formats and random-looking strings
without a keyword beside them) are reported only if the corpus says that they
are live: the SHA-256 of the candidate's value is aggregated over the corpus by
distinct repositories and owners, and

* a value that at least ``COPIED_OWNERS`` owners hold is a widely copied example
  (documentation, fixtures, lock files), whatever it looks like;
* a value that fewer owners hold is owner-specific and looks live.

The same verdict is attached to the base candidates, which stay in any case.
The owner of a document is ``owner_col`` and its repository is the pair
(owner, ``repo_col``).

Plan.  One Arrow pass gives a lean table of candidates (never the text), which
is staged once.  Frequencies come from two aggregations with map-side combine,
first by (value, owner, repository), then by value, so a value that a third of
all rows hold arrives at its reducer as one row per owner.  Only the hash of a
value leaves the scan, never the secret.

Defined results: a null or empty text has no candidates, zero counts, empty
spans and the SHA-256 of the empty string; null owners count as one owner of
their own; repeated rows are kept, one result per row; offsets are code points,
end exclusive.  A method candidate that overlaps a base span is part of it and
is left out.  Extra columns are never read.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.session import stage

COPIED_OWNERS = 5  # so many distinct owners make a value a copied example
MIN_RANDOM_CHARS = 24
MIN_ENTROPY_BITS = 3.5  # per character, of a random-looking string

# The base kinds, in the order that breaks ties of spans, and their least sizes.
BASE_KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ASSIGN_WORDS = ("passw", "secret", "token", "key")
ASSIGN_LEAST = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
HEX = re.compile(r"[0-9a-f]{24,}")

# Public formats of issued tokens.
ISSUED = {
    "github": ("gh", re.compile(r"gh[pousr]_[A-Za-z0-9]{36,}")),
    "slack": ("xox", re.compile(r"xox[abprs]-[A-Za-z0-9-]{10,}")),
    "stripe": ("k_live_", re.compile(r"[rs]k_live_[A-Za-z0-9]{16,}")),
    "google": ("AIza", re.compile(r"AIza[A-Za-z0-9_-]{35}")),
    # only the first eyJ of a run can begin a token: what follows the run decides for all of them alike
    "jwt": ("eyJ", re.compile(r"(?<![A-Za-z0-9_-])(?:(?!eyJ)[A-Za-z0-9_-])*+(eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,})")),
    "private_key": ("PRIVATE KEY", re.compile(r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----")),
}
RANDOM = re.compile(rf"[A-Za-z0-9+/_-]{{{MIN_RANDOM_CHARS},}}={{0,2}}")

RANK = {k: i for i, k in enumerate((*BASE_KINDS, *ISSUED, "random"))}
CANDIDATE = "kind string, rank int, start long, stop long, value_hash string"


def base_matches(text: str) -> Iterator[tuple[str, int, int, str]]:
    """(kind, start, end, value), leftmost and non-overlapping for each kind."""
    lowered = text.lower()
    if any(w in lowered for w in ASSIGN_WORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= ASSIGN_LEAST:
                yield "assign", m.start(), m.end(), m[2]
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= ACCESS_LEAST:
                yield "access", m.start(), m.end(), m[0]
    for m in HEX.finditer(text):
        yield "hex", m.start(), m.end(), m[0]


def looks_random(value: str) -> bool:
    """Digits and letters mixed, with many different characters."""
    if not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
        return False
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) >= MIN_ENTROPY_BITS


def method_matches(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[str, int, int, str]]:
    """Candidates of the other kinds that overlap neither a taken span nor each other."""
    held: list[tuple[int, int]] = []  # disjoint, in order
    for a, b in sorted(taken):
        if held and a < held[-1][1]:
            held[-1] = (held[-1][0], max(b, held[-1][1]))
        else:
            held.append((a, b))

    def free(a: int, b: int) -> bool:
        i = bisect_left(held, (a, b))
        return (i == len(held) or b <= held[i][0]) and (i == 0 or held[i - 1][1] <= a)

    for kind, (hint, pattern) in ISSUED.items():
        if hint in text:
            for m in pattern.finditer(text):
                start, end = m.span(pattern.groups)  # the one group, if there is one
                if free(start, end):
                    insort(held, (start, end))
                    yield kind, start, end, text[start:end]
    for m in RANDOM.finditer(text):
        if looks_random(m[0]) and free(m.start(), m.end()):
            yield "random", m.start(), m.end(), m[0]


def scan_text(text: str) -> tuple[list[tuple], list[tuple]]:
    base = sorted(base_matches(text), key=lambda s: (s[1], RANK[s[0]]))
    return base, list(method_matches(text, [s[1:3] for s in base]))


def joined(spans: list[tuple]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b, _ in spans)


def scan(df: DataFrame, id_col: str, text_col: str, owner_col: str, repo_col: str) -> DataFrame:
    """One lean row per input row: base counts, base digest and all candidates."""
    id_type = df.schema[id_col].dataType.simpleString()
    names = ["_row", id_col, "_owner", "_repo", "n_assign", "n_access", "n_hex", "base_sha256", "_found"]
    found_type = pa.list_(pa.struct([("kind", pa.string()), ("rank", pa.int32()), ("start", pa.int64()), ("stop", pa.int64()), ("value_hash", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {k: [] for k in BASE_KINDS}
            digests, found = [], []
            for value in batch.column(4):
                base, extra = scan_text(value.as_py() or "")
                per_kind = Counter(s[0] for s in base)
                for k in BASE_KINDS:
                    counts[k].append(per_kind[k])
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                found.append([{"kind": k, "rank": RANK[k], "start": a, "stop": b, "value_hash": hashlib.sha256(v.encode()).hexdigest()} for k, a, b, v in base + extra])
            columns = [batch.column(i) for i in range(4)] + [pa.array(counts[k], pa.int64()) for k in BASE_KINDS]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(digests, pa.string()), pa.array(found, found_type)], names=names)

    rows = df.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id_col),
        F.col(owner_col).cast("string").alias("_owner"), F.col(repo_col).cast("string").alias("_repo"),
        F.col(text_col).cast("string").alias("_text"),
    )
    return rows.mapInArrow(
        run,
        f"_row long, `{id_col}` {id_type}, _owner string, _repo string, n_assign long, n_access long, n_hex long, base_sha256 string, _found array<struct<{CANDIDATE}>>",
    )


def ownership(candidates: DataFrame) -> DataFrame:
    """``(value_hash, n_owners, n_repositories, n_copies)`` over the whole corpus."""
    owner, repo = F.coalesce("_owner", F.lit("\0")), F.coalesce("_repo", F.lit("\0"))
    held = candidates.groupBy("value_hash", owner.alias("o"), repo.alias("r")).agg(F.count(F.lit(1)).alias("n"))
    owned = held.groupBy("value_hash", "o").agg(F.count(F.lit(1)).alias("repos"), F.sum("n").alias("n"))
    return owned.groupBy("value_hash").agg(
        F.count(F.lit(1)).alias("n_owners"), F.sum("repos").alias("n_repositories"), F.sum("n").alias("n_copies")
    )


def scan_secrets(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "lang", copied_owners: int = COPIED_OWNERS
) -> tuple[DataFrame, DataFrame]:
    """``(documents, candidates)``.

    documents: id, ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``,
    ``spans`` (base spans and live method spans), ``n_live``, ``n_copied``.
    candidates: one row per candidate with its ownership figures and ``live``.
    """
    rows = stage(scan(df, id_col, text_col, owner_col, repo_col))
    candidates = rows.select("_row", id_col, "_owner", "_repo", F.inline("_found"))
    judged = candidates.join(ownership(candidates), "value_hash").withColumn("live", F.col("n_owners") < copied_owners)
    kept = judged.where((F.col("rank") < len(BASE_KINDS)) | F.col("live"))
    per_row = kept.groupBy("_row").agg(
        F.sort_array(F.collect_list(F.struct("start", "rank", "stop", "kind"))).alias("_s"),
        F.sum(F.col("live").cast("long")).alias("n_live"),
        F.sum((~F.col("live")).cast("long")).alias("n_copied"),
    )
    text = F.array_join(F.transform("_s", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
    documents = rows.drop("_found").join(per_row, "_row", "left").select(
        id_col, "n_assign", "n_access", "n_hex", "base_sha256",
        F.coalesce(text, F.lit("")).alias("spans"),
        F.coalesce("n_live", F.lit(0)).cast("long").alias("n_live"),
        F.coalesce("n_copied", F.lit(0)).cast("long").alias("n_copied"),
    )
    return documents, judged.drop("_row", "rank")
