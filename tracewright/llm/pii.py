"""Personal data by weak supervision, with DataFrame functions only.

Base spans come from four patterns with checks. Beyond them, one pattern proposes candidate spans (secrets, account
numbers, identity numbers, local telephone numbers, disguised addresses); regex, gazetteer and context labelers vote on
each. Votes are counted over the whole corpus (a labeler votes yes, no or abstains, so there are 3^5 vote patterns at
most, whatever the corpus); expectation-maximisation on those counts estimates prevalence and each labeler's
reliabilities. The posteriors then weight counts of span features, which give the final span classifier, a naive Bayes
model whose weights are literals in the second pass over the texts.

Patterns start only where a run of their characters starts, and repeat possessively, so they take linear time on any text.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOCAL = r"[A-Za-z0-9._%+-]"
#: Kind, what a text must hold before the pattern is tried, pattern. Matches equal those of the plain patterns.
BASE = (
    ("email", r"@[A-Za-z0-9-]", rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", r"[0-9]\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", r"[0-9](?:[\x20-]?[0-9]){13}", r"[0-9](?:[\x20-]?[0-9])++"),
    ("phone", r"\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]"),
)
_RUN = "[A-Za-z0-9_+/-]"
TOKEN = rf"(?<!{_RUN})(?=[0-9_+/-]*+[A-Za-z])(?=[A-Za-z_+/-]*+[0-9]){_RUN}{{16,}}+"
IDENTITY = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
LOCAL_PHONE = r"(?<!\+[0-9]{1,3} ?)\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9-])"
DISGUISED = r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{2,64}+ ?[\[(]at[\])] ?[A-Za-z0-9-]{2,63}+(?: ?[\[(]dot[\])] ?[A-Za-z0-9-]{2,63}+)++"
ISSUED = rf"(?<!{_RUN})A[KS]IA[0-9A-Z]{{16}}(?!{_RUN})"
CANDIDATE = "|".join((ISSUED, TOKEN, IDENTITY, LOCAL_PHONE, DISGUISED))
CANDIDATE_GUARD = r"[A-Za-z0-9_+/-]{16}|[0-9]{3}-[0-9]|[\[(]at[\])]"

#: Words beside which a span is likely private.
GAZETTEER = ("password", "passwd", "pwd", "token", "secret", "api_key", "apikey", "access key", "private key", "credential", "ssn", "social security", "passport", "iban", "account", "phone", "tel", "mobile", "contact", "mail")
LABELERS = ("shape", "gazetteer", "assigned", "mixture", "switches")
MIN_LINKED = 0.5
_SPAN = "struct<s:int,k:int,e:int,kind:string>"


def _scan(values: Column, op) -> Column:
    """Inclusive prefix combination in log2(n) passes."""
    passes = F.sequence(F.lit(0), F.greatest(F.ceil(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int"), F.lit(0)))
    return F.aggregate(passes, values, lambda acc, k: F.transform(acc, lambda x, i: F.when(i >= F.pow(F.lit(2), k).cast("int"), op(x, F.get(acc, i - F.pow(F.lit(2), k).cast("int")))).otherwise(x)))


def _located(df: DataFrame, name: str, text: str, guard: str, pattern: str) -> DataFrame:
    """name: array of (m, s, e, before, after) for the matches of pattern, in code points, end exclusive."""
    m, p = f"_{name}_m", f"_{name}_p"
    try_it = F.col(text).rlike(guard)
    df = df.withColumn(m, F.when(try_it, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))
    df = df.withColumn(p, F.when(F.size(m) > 0, F.split(text, pattern, -1)))
    lengths = F.transform(F.col(m), lambda x, i: F.length(x) + F.length(F.get(p, i)))
    ends = f"_{name}_e"
    df = df.withColumn(ends, F.when(F.size(m) > 0, _scan(lengths, lambda a, b: a + b)))
    found = F.transform(
        F.col(ends),
        lambda e, i: F.struct(F.get(m, i).alias("m"), (e - F.length(F.get(m, i))).alias("s"), e.alias("e"), F.right(F.get(p, i), F.lit(24)).alias("before"), F.left(F.get(p, i + 1), F.lit(8)).alias("after")),
    )
    return df.withColumn(name, F.coalesce(found, F.expr("array()").cast("array<struct<m:string,s:int,e:int,before:string,after:string>>"))).drop(m, p, ends)


def _valid(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(digits)
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda x: F.length(F.regexp_replace(x, "^0+(?=[0-9])", "")) < 4) & F.forall(F.split(m, r"\."), lambda x: F.right(x, F.lit(3)).cast("int") < 256)
    if kind == "card":
        doubled = lambda d: F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        at = lambda i: F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        luhn = F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda a, i: a + F.when(i % 2 == 0, doubled(at(i))).otherwise(at(i)))
        return F.when(n.between(14, 19), luhn % 10 == 0).otherwise(False)
    return n.between(10, 15) if kind == "phone" else F.lit(True)


def _base_spans(rank: int, kind: str) -> Column:
    valid = F.filter(f"_{kind}", lambda c: _valid(kind, c["m"]))
    return F.transform(valid, lambda c: F.struct(c["s"].alias("s"), F.lit(rank).alias("k"), c["e"].alias("e"), F.lit(kind).alias("kind")))


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")


def _vote(yes: Column, no: Column | None = None) -> Column:
    """2 yes, 0 no, 1 abstain."""
    return F.when(yes, 2).when(no, 0).otherwise(1) if no is not None else F.when(yes, 2).otherwise(1)


def _described(c: Column) -> Column:
    """A candidate with its kind, its votes as a base-3 number, and its features as bucket numbers."""
    m, before = c["m"], F.lower(c["before"])
    n = F.length(m)
    digits = F.length(F.regexp_replace(m, "[^0-9]", "")) / n
    runs = F.size(F.regexp_extract_all(m, F.lit("[0-9]+|[^0-9]+"), F.lit(0)))
    number, address = m.rlike(r"^[(0-9][0-9() -]+$"), m.rlike(r"[\[(]at[\])]")
    known = m.rlike(r"^(A[KS]IA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9-]{16,}|eyJ[A-Za-z0-9_-]{16,}|[0-9a-f]{16,}|[0-9A-F]{16,}|[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30})$") | number | address
    named = reduce(lambda a, b: a | b, (before.contains(w) for w in GAZETTEER))
    assigned = c["before"].rlike(r"[=:]\s?[\"']?$")
    votes = (
        _vote(known, m.rlike("^[a-z_-]+[0-9]{0,4}$") | m.rlike(r"[/_-].*[/_-].*[/_-]")),
        _vote(named),
        _vote(assigned, c["before"].rlike(r"[/.#]$")),
        _vote(digits.between(0.15, 0.85) | address, ~known & ~digits.between(0.02, 0.98)),
        _vote((runs >= 5) | number | address, ~known & (runs <= 2)),
    )
    kind = F.when(address, "contact").when(m.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "identity").when(number, "contact").when(m.rlike("^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$"), "account").otherwise("secret")
    features = (F.least(F.floor(n / 8), F.lit(7)), F.floor(digits * 4), F.least(runs, F.lit(9)), m.rlike("[A-Z]").cast("int") * 2 + m.rlike("[a-z]").cast("int"), named.cast("int"), assigned.cast("int"), known.cast("int"))
    code = reduce(lambda a, v: a * 3 + v, votes)
    return F.struct(c["s"].alias("s"), c["e"].alias("e"), kind.alias("kind"), code.cast("int").alias("votes"), F.array(*(f.cast("int") for f in features)).alias("f"))


def _candidates(df: DataFrame, text: str) -> DataFrame:
    df = _located(df, "_c", text, CANDIDATE_GUARD, CANDIDATE)
    own = F.filter("_c", lambda c: ~c["after"].startswith("@") & ~c["before"].endswith("@"))
    return df.withColumn("_c", F.transform(own, _described))


def reliabilities(counts: dict[int, int], labelers: int = len(LABELERS), rounds: int = 60) -> tuple[float, list[tuple[float, float]], dict[int, float]]:
    """Expectation-maximisation on counts of vote patterns: prevalence, (P(yes | private), P(yes | not)) of each labeler, posteriors."""
    patterns = {code: [code // 3 ** (labelers - 1 - i) % 3 for i in range(labelers)] for code in counts}
    post = {code: min(0.95, max(0.05, (sum(v) + 0.5) / (2 * labelers + 1))) for code, v in patterns.items()}
    prior, rates = 0.5, [(0.8, 0.2)] * labelers
    for _ in range(rounds):
        total = sum(counts.values())
        prior = (sum(n * post[c] for c, n in counts.items()) + 1) / (total + 2)
        rates = []
        for i in range(labelers):
            sums = [[1.0, 1.0], [1.0, 1.0]]  # class, vote; one of each beforehand
            sums[1][1] += 1
            sums[0][0] += 1
            for c, n in counts.items():
                if patterns[c][i] != 1:
                    sums[1][patterns[c][i] // 2] += n * post[c]
                    sums[0][patterns[c][i] // 2] += n * (1 - post[c])
            rates.append((sums[1][1] / sum(sums[1]), sums[0][1] / sum(sums[0])))
        for c, v in patterns.items():
            log = math.log(prior / (1 - prior))
            for i, (hit, false) in enumerate(rates):
                if v[i] != 1:
                    log += math.log(hit / false) if v[i] == 2 else math.log((1 - hit) / (1 - false))
            post[c] = 1 / (1 + math.exp(-max(-30.0, min(30.0, log))))
    return prior, rates, post


#: Buckets of each feature.
_BUCKETS = (8, 5, 10, 4, 2, 2, 2)


def train(docs: DataFrame, text: str = "text") -> tuple[float, list[list[float]]]:
    """Bias and weights of the span classifier, from the candidates of all docs. What comes to the driver has at most
    3^5 vote patterns times 33 feature buckets, whatever the corpus."""
    seen = _candidates(docs.select(F.coalesce(F.col(text), F.lit("")).alias("_t")), "_t").select(F.explode("_c").alias("c"))
    rows = seen.select(F.col("c.votes").alias("v"), F.posexplode("c.f").alias("i", "b")).groupBy("v", "i", "b").count().collect()
    counts = {}
    for r in rows:
        if r.i == 0:
            counts[r.v] = counts.get(r.v, 0) + r["count"]
    prior, _, post = reliabilities(counts) if counts else (0.5, [], {})
    sums = [[[0.5, 0.5] for _ in range(n)] for n in _BUCKETS]
    for r in rows:
        sums[r.i][r.b][1] += r["count"] * post[r.v]
        sums[r.i][r.b][0] += r["count"] * (1 - post[r.v])
    weights = []
    for f in sums:
        yes, no = sum(x[1] for x in f), sum(x[0] for x in f)
        weights.append([math.log(x[1] / yes) - math.log(x[0] / no) for x in f])
    return math.log(prior / (1 - prior)), weights


def detect(docs: DataFrame, text: str = "text", model: tuple | None = None) -> DataFrame:
    """docs with base and more: arrays of spans (s, k, e, kind), ordered; s and e in code points, end exclusive, k the kind's rank.

    more holds the classifier's spans that touch no base span or hold it whole. Null texts have none.
    """
    bias, weights = model or train(docs, text)
    df = docs.withColumn("_t", F.coalesce(F.col(text), F.lit("")))
    for kind, guard, pattern in BASE:
        df = _located(df, f"_{kind}", "_t", guard, pattern)
    parts = [_base_spans(i, kind) for i, (kind, _, _) in enumerate(BASE)]
    df = df.withColumn("base", F.array_sort(F.concat(*parts))).drop(*(f"_{kind}" for kind, _, _ in BASE))
    df = _candidates(df, "_t")
    tables = [F.array(*(F.lit(float(x)) for x in w)) for w in weights]
    score = lambda c: reduce(lambda a, b: a + b, (F.get(t, F.get(c["f"], i)) for i, t in enumerate(tables)), F.lit(float(bias)))
    kept = F.filter("_c", lambda c: (score(c) >= math.log(MIN_LINKED / (1 - MIN_LINKED))) & ~F.exists("base", lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"]) & ~((c["s"] <= b["s"]) & (b["e"] <= c["e"]))))
    more = F.transform(kept, lambda c: F.struct(c["s"].alias("s"), F.lit(len(BASE)).alias("k"), c["e"].alias("e"), c["kind"].alias("kind")))
    return df.withColumn("more", F.when(F.size("_c") > 0, more).otherwise(F.expr("array()").cast(f"array<{_SPAN}>"))).drop("_c", "_t")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_more for every row of docs (columns doc_id, text).

    The four counts are of base spans; spans also lists the classifier's (kinds secret, account, identity, contact).
    Null and empty texts have no spans: counts 0, the hash of the empty string and an empty list. Repeated rows and null
    ids are kept; an empty table gives an empty result. Other columns are ignored.
    """
    found = detect(docs.select("doc_id", "text")).select("doc_id", "base", "more")
    return found.select("doc_id", *(_count(kind) for kind, _, _ in BASE), F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.array_sort(F.concat("base", "more"))).alias("spans"), F.size("more").cast("long").alias("n_more"))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with every span of text replaced by its kind in angle brackets.

    Null texts stay null, empty ones empty; repeated rows and null ids are kept; an empty table stays empty. All other
    columns are kept as they are, whatever their names.
    """
    names = docs.columns
    own = [f"c{i}" for i in range(len(names))]
    text = own[names.index(text)]
    df = detect(docs.toDF(*own), text).withColumn("_s", F.array_sort(F.concat("base", "more")))
    df = df.withColumn("_r", F.when(F.size("_s") > 0, _scan(F.transform("_s", lambda x: x["e"]), lambda a, b: F.greatest(a, b))))
    before = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get("_r", i - 1))
    piece = lambda x, i: F.when(x["e"] > before(i), F.concat(F.substring(F.col(text), before(i) + 1, F.greatest(x["s"] - before(i), F.lit(0))), F.lit("<"), x["kind"], F.lit(">"))).otherwise("")
    end = F.element_at("_r", -1)
    new = F.concat(F.array_join(F.transform("_s", piece), ""), F.substring(F.col(text), end + 1, F.length(text)))
    return df.withColumn(text, F.when(F.size("_s") > 0, new).otherwise(F.col(text))).select(*own).toDF(*names)
