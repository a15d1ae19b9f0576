"""Quality rules as a ledger: measured once, judged once, then any policy is a bit mask.

Each document gets its measurements and one bit for each rule it fails. A policy names the rules that count,
as a mask with a version, so a new policy or the question what a rule alone rejects needs no text again.
Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.common import fresh

# White space between words, and what counts as a symbol.
SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[ \t-\r]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 3

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rule:
    """A condition on the measurements under which a document fails; its place in the list is its bit."""

    name: str
    fails: str


# In order; new rules go to the end, so that the bits of stored ledgers keep their meaning.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "100 * n_symbols > 25 * word_chars"),
    Rule("repeated_lines", "n_lines > 3 and 100 * n_dup_lines > 50 * n_lines"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """A version of the set of rules by which documents are rejected."""

    name: str
    version: int
    rules: tuple[str, ...]

    def mask(self, rules: Sequence[Rule] = RULES) -> int:
        names = [rule.name for rule in rules]
        return sum(1 << names.index(name) for name in set(self.rules))


BASE = Policy("base", 1, ("few_words", "repeated_words"))
STANDARD = Policy("standard", 1, tuple(rule.name for rule in RULES))
# The second version leaves out the lengths of words, which differ from language to language.
ANY_LANGUAGE = Policy("standard", 2, ("few_words", "repeated_words", "symbols", "repeated_lines"))


def _count(array: Column) -> Column:
    return F.coalesce(F.size(array), F.lit(0)).cast("bigint")


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns in MEASURES; a column of that name is replaced. No shuffle.

    Words are runs of anything but white space. ``n_repeat_words`` counts the words in windows of three
    that occur twice or more in the text. A NULL or empty text has no words, and all its measures are 0.
    """
    kept = [column for column in docs.columns if column.lower() not in MEASURES]
    names = {name: fresh(docs.columns, f"_{name}") for name in ("bare", "words", "windows", "ordered", "at", "lines")}
    bare, words, windows, ordered, at, lines = (F.col(name) for name in names.values())
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))

    # Each array is a column of its own and used more than once, so that it is made once.
    step = docs.withColumn(names["bare"], F.btrim(text, F.lit(SPACE)))
    step = step.withColumn(
        names["words"], F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACES))
    )
    step = step.withColumn(names["lines"], F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != ""))
    hashes = F.transform(words, lambda word, i: F.xxhash64(word, F.get(words, i + 1), F.get(words, i + 2)))
    whole = F.greatest(F.size(words) - (WINDOW - 1), F.lit(0))
    step = step.withColumn(names["windows"], F.slice(hashes, F.lit(1), whole))
    pairs = F.transform(windows, lambda window, i: F.struct(window.alias("window"), i.alias("i")))
    repeats = F.size(F.array_distinct(windows)) < F.size(windows)
    step = step.withColumn(names["ordered"], F.when(repeats, F.sort_array(pairs)))
    found = F.filter(
        ordered,
        lambda entry, k: (entry["window"] == F.get(ordered, k - 1)["window"])
        | (entry["window"] == F.get(ordered, k + 1)["window"]),
    )
    step = step.withColumn(names["at"], F.sort_array(F.transform(found, lambda entry: entry["i"])))
    covers = F.transform(at, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - i, F.lit(WINDOW))))
    repeated = F.aggregate(covers, F.lit(0).cast("bigint"), lambda total, n: total + n)
    measures = {
        "n_words": _count(words),
        "word_chars": F.length(F.regexp_replace(bare, SPACES, "")).cast("bigint"),
        "n_symbols": (F.length(bare) - F.length(F.regexp_replace(bare, SYMBOLS, ""))).cast("bigint"),
        "n_lines": _count(lines),
        "n_dup_lines": _count(lines) - _count(F.array_distinct(lines)),
        "n_repeat_words": F.coalesce(repeated, F.lit(0).cast("bigint")),
    }
    # Through a generator: filters and groupings above would else take the expressions in and work them out again.
    row = F.struct(*[value.alias(name) for name, value in measures.items()])
    return step.select(*[F.col(f"`{name}`") for name in kept], F.inline(F.array(row)))


def ledger(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``measured``, and the rules each document fails in ``failed_bits``, a bigint; up to 63 rules."""
    if len(rules) > 63:
        raise ValueError("a ledger holds up to 63 rules")
    bits = F.lit(0).cast("bigint")
    for i, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")))
    return measured(docs).withColumn("failed_bits", bits)


def rejected_by(policy: Policy, rules: Sequence[Rule] = RULES) -> Column:
    """Whether a row of a ledger fails a rule of the policy."""
    return F.col("failed_bits").bitwiseAND(F.lit(policy.mask(rules)).cast("bigint")) != 0


def ablation(entries: DataFrame, policies: Sequence[Policy], rules: Sequence[Rule] = RULES) -> DataFrame:
    """For each policy and rule in it: documents that fail the rule, and those that nothing else rejects.

    The ledger is counted by its bits first, at most one row for each set of rules in a task; the rest
    works on those counts. Empty ledgers give no rows.
    """
    by_bits = entries.groupBy("failed_bits").agg(F.count(F.lit(1)).alias("documents"))
    lines = [
        F.struct(
            F.lit(policy.name).alias("policy"),
            F.lit(policy.version).alias("version"),
            F.lit(rule.name).alias("rule"),
            F.lit(1 << i).cast("bigint").alias("bit"),
            F.lit(policy.mask(rules)).cast("bigint").alias("mask"),
        )
        for policy in policies
        for i, rule in enumerate(rules)
        if rule.name in policy.rules
    ]
    each = by_bits.select("failed_bits", "documents", F.inline(F.array(*lines)))
    counted = F.col("failed_bits").bitwiseAND(F.col("mask"))
    none = F.lit(0).cast("bigint")
    return each.groupBy("policy", "version", "rule").agg(
        F.sum(F.when(counted.bitwiseAND(F.col("bit")) != 0, F.col("documents")).otherwise(none)).alias("fail"),
        F.sum(F.when(counted == F.col("bit"), F.col("documents")).otherwise(none)).alias("fail_only_this"),
        F.sum(F.when(counted != 0, F.col("documents")).otherwise(none)).alias("rejected"),
    )


def judged(docs: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """doc_id, the measurements, the bits, ``base_failed`` and ``kept``; one row for each row of ``docs``."""
    entries = ledger(docs.select("doc_id", "text"))
    base_failed = rejected_by(BASE)
    return entries.select(
        "doc_id", *MEASURES, "failed_bits", base_failed.alias("base_failed"), (~base_failed & ~rejected_by(policy)).alias("kept")
    )


def kept_documents(docs: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """The rows of ``docs`` that the base rules and the policy keep, with the columns they came with."""
    whole = fresh(docs.columns, "_row")
    rows = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias(whole), F.col("text"))
    # Taken by a generator: a filter would be moved below the measurements and work them out once for each rule.
    passed = F.when(~rejected_by(BASE) & ~rejected_by(policy), F.array(F.col(whole)))
    return ledger(rows).select(F.explode(passed).alias(whole)).select(*[F.col(whole)[name].alias(name) for name in docs.columns])


# The same for DuckDB.
_LEDGER_SQL = r"""
with bare as (
  select doc_id, coalesce(text, '') as whole,
         trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as t
  from documents
),
split as (
  select doc_id, t, case when t = '' then [] else regexp_split_to_array(t, '[ \t-\r]+') end as w,
         list_filter(string_split(whole, chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) as l
  from bare
),
windows as (
  select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as k
  from split, unnest(range(1, greatest(len(w) - 1, 1))) as u(i)
),
repeated as (
  select doc_id, i from windows qualify count(*) over (partition by doc_id, k) > 1
),
covered as (
  select doc_id, count(distinct p) as n
  from (select doc_id, unnest([i, i + 1, i + 2]) as p from repeated) group by doc_id
),
measures as (
  select s.doc_id, len(w)::bigint as n_words, length(regexp_replace(t, '[ \t-\r]+', '', 'g'))::bigint as word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
         len(l)::bigint as n_lines, (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
         coalesce(c.n, 0)::bigint as n_repeat_words
  from split s left join covered c on s.doc_id = c.doc_id
),
bits as (
  select *, (case when n_words < 50 then 1 else 0 end
    + case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end
    + case when 100 * n_symbols > 25 * word_chars then 4 else 0 end
    + case when n_lines > 3 and 100 * n_dup_lines > 50 * n_lines then 8 else 0 end
    + case when word_chars > 20 * n_words then 16 else 0 end
    + case when word_chars < 2 * n_words then 32 else 0 end)::bigint as failed_bits
  from measures
)
"""
ORACLE_SQL = f"{_LEDGER_SQL} select *, (failed_bits & 3) <> 0 as base_failed, failed_bits = 0 as kept from bits"
ABLATION_SQL = f"""
{_LEDGER_SQL},
policies as (
  select * from (values ('base', 1, 3), ('standard', 1, 63), ('standard', 2, 15)) as p(policy, version, mask)
),
rules as (
  select unnest(['few_words', 'repeated_words', 'symbols', 'repeated_lines', 'long_words', 'short_words']) as rule,
         unnest([1, 2, 4, 8, 16, 32]) as bit
)
select policy, version, rule, count(*) filter (failed_bits & mask & bit <> 0) as fail,
       count(*) filter (failed_bits & mask = bit) as fail_only_this, count(*) filter (failed_bits & mask <> 0) as rejected
from bits, policies, rules where mask & bit <> 0 group by policy, version, rule
"""
