"""Exercise labels against a versioned vocabulary: normalized, then decided by a ladder, never guessed.

Only text normalization and the phrase parser, which Spark has no functions for, run in Python, by
Arrow batches and once per distinct label; every stage of the ladder is a join with the (small, checked)
vocabulary.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonnage.functions.ids import make_id, plain_id, text_part
from tonnage.functions.versions import CURRENT
from tonnage.plans.schema import TABLES

#: Whole-token abbreviations.
ABBREVIATIONS = {
    "db": "dumbbell", "dbs": "dumbbell", "dbel": "dumbbell", "dbell": "dumbbell", "dbells": "dumbbell", "dumbels": "dumbbell", "dumbells": "dumbbell",
    "kb": "kettlebell", "kbs": "kettlebell", "kbel": "kettlebell", "kbells": "kettlebell", "ohp": "overhead press", "rdl": "romanian deadlift",
    "rdls": "romanian deadlift", "dl": "deadlift", "tbar": "t bar", "1ct": "1 count", "2ct": "2 count", "3ct": "3 count", "ct": "count",
}
#: Names of several tokens that become one.
COMPOUNDS = {
    "lat pull down": "latpulldown", "bench press": "benchpress", "overhead press": "overheadpress", "lat pulldown": "latpulldown", "pull down": "pulldown",
    "good morning": "goodmorning", "leg press": "legpress", "chest press": "chestpress", "close grip": "closegrip", "wide grip": "widegrip", "low bar": "lowbar", "high bar": "highbar",
}
#: Plurals that become singular.
PLURALS = {
    "barbells": "barbell", "benches": "bench", "cables": "cable", "dumbbells": "dumbbell", "kettlebells": "kettlebell", "presses": "press", "squats": "squat",
    "deadlifts": "deadlift", "curls": "curl", "pulls": "pull", "rows": "row", "raises": "raise", "flies": "fly", "dips": "dip", "extensions": "extension",
    "pushdowns": "pushdown", "pulldowns": "pulldown", "pullups": "pullup", "lunges": "lunge", "thrusts": "thrust", "shrugs": "shrug", "crunches": "crunch",
    "situps": "situp", "stepups": "stepup", "legpresses": "legpress", "mornings": "morning", "goodmornings": "goodmorning", "sideplanks": "sideplank", "planks": "plank",
}
#: Phrases that state a descriptor, in the order in which they are looked for.
PHRASES = {
    "grip": (("close grip", "close"), ("closegrip", "close"), ("wide grip", "wide"), ("widegrip", "wide"), ("neutral grip", "neutral"), ("mixed grip", "mixed"), ("competition grip", "competition"), ("overhand", "overhand"), ("underhand", "underhand"), ("supinated", "supinated"), ("pronated", "pronated")),
    "stance": (("low bar", "low"), ("lowbar", "low"), ("high bar", "high"), ("highbar", "high"), ("sumo", "wide"), ("conventional", "moderate"), ("wide", "wide"), ("moderate", "moderate"), ("narrow", "narrow"), ("split", "split")),
    "pause_rule": (("touch and go", "none"), ("long pause", "long"), ("3 count", "count_3"), ("2 count", "count_2"), ("paused", "brief"), ("pause", "brief")),
    "tempo": (("controlled eccentric", "controlled_eccentric"), ("eccentric", "controlled_eccentric"), ("tempo", "tempo_prescribed")),
    "range_of_motion": (("short", "reduced"), ("reduced", "reduced"), ("partial", "partial"), ("deficit", "elevated_start"), ("competition", "competition"), ("full", "full")),
    "implement": (("body weight", "bodyweight"), ("bodyweight", "bodyweight"), ("smith machine", "smith_machine"), ("smith", "smith_machine"), ("machine", "machine"), ("cable", "cable"), ("barbell", "barbell"), ("dumbbell", "dumbbell"), ("kettlebell", "kettlebell"), ("band", "band")),
}
#: Tokens that name a family, and those of a label that only asks for some variation.
FAMILIES = {"squat": "squat", "bench": "bench", "benchpress": "bench", "deadlift": "deadlift"}
ACCESSORIES = frozenset(
    "calf carry clean crunch curl dip extension farmer fly goodmorning jerk latpulldown lunge plank pulldown pullup pushdown raise reverse row shrug situp sissy sideplank snatch stepup thrust upright".split()
)
GENERIC = frozenset(("variation", "variations", "var", "vars"))
DESCRIPTORS = tuple(PHRASES)
UNKNOWN = "unknown"
_LONGEST = sorted({len(k.split()) for k in COMPOUNDS}, reverse=True)


def normalize(raw: str) -> tuple[str, list[str], bool]:
    """(text, names of the rules that changed it, whether it ends in a question mark)."""
    rules: list[str] = []

    def step(name: str, before, after):
        if after != before:
            rules.append(name)
        return after

    text = step("unicode_nfkc", raw, unicodedata.normalize("NFKC", raw))
    text = step("unicode_casefold", text, text.casefold())
    text = step("unicode_nfkc_recheck", text, unicodedata.normalize("NFKC", text))
    question = text.rstrip().endswith("?")
    if question:
        rules.append("question_form")
    text = step("strip_diacritics", text, "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)))
    text = step("punctuation_to_space", text, "".join(c if c.isascii() and c.isalnum() else " " for c in text))
    text = step("collapse_whitespace", text, " ".join(text.split()))
    tokens = text.split()
    tokens = step("expand_abbreviation", tokens, [x for t in tokens for x in ABBREVIATIONS.get(t, t).split()])
    tokens = step("fold_plural", tokens, [PLURALS.get(t, t) for t in tokens])
    tokens = step("join_compound", tokens, _joined(tokens))
    return " ".join(tokens), rules, question


def _joined(tokens: list[str]) -> list[str]:
    out, at = [], 0
    while at < len(tokens):
        n = next((n for n in _LONGEST if " ".join(tokens[at : at + n]) in COMPOUNDS and at + n <= len(tokens)), 1)
        phrase = " ".join(tokens[at : at + n])
        out.append(COMPOUNDS.get(phrase, phrase) if n > 1 else phrase)
        at += n
    return out


def features(text: str) -> dict[str, str]:
    """family and descriptors that a normalized label states; what it does not state is ``unknown``."""
    tokens, found = text.split(), {}
    for name, phrases in PHRASES.items():
        found[name] = UNKNOWN
        for phrase, value in phrases:
            words = phrase.split()
            at = next((k for k in range(len(tokens) - len(words) + 1) if tokens[k : k + len(words)] == words), None)
            if at is not None:
                found[name], tokens = value, tokens[:at] + tokens[at + len(words) :]
                break
    named = {FAMILIES.get(t, "accessory") for t in tokens if t in FAMILIES or t in ACCESSORIES}
    return found | {"family": named.pop() if len(named) == 1 else UNKNOWN}


_PARSED = T.StructType([T.StructField("text", T.StringType()), T.StructField("rules", T.ArrayType(T.StringType())), T.StructField("question", T.BooleanType()), *(T.StructField(c, T.StringType()) for c in ("family", *DESCRIPTORS))])


@F.pandas_udf(_PARSED)
def parsed(labels: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in labels:
        rows = []
        for raw in batch:
            text, rules, question = normalize(raw or "")
            rows.append({"text": text, "rules": rules, "question": question} | features(text))
        yield pd.DataFrame(rows, columns=_PARSED.names)


@dataclass(frozen=True)
class Vocabulary:
    """Definitions, aliases and refusals; small by declaration and checked for contradictions."""

    definitions: tuple[dict, ...]
    aliases: tuple[dict, ...]
    refusals: tuple[dict, ...]

    @classmethod
    def of(cls, definitions: list[dict], aliases: list[dict], refusals: list[dict]) -> Vocabulary:
        """``definitions``: key, name, parent_lift and descriptors; ``aliases``: source_system, alias, key; ``refusals``: label, status, reason, parent_lift, candidates."""
        if max(map(len, (definitions, aliases, refusals))) > 100_000:
            raise ValueError("a vocabulary of so many entries is not sent to every task")
        keys = [d["key"] for d in definitions]
        problems = [f"key {k} twice" for k in {k for k in keys if keys.count(k) > 1}]
        texts: dict[str, str] = {}
        for d in definitions:
            for label in (d["key"].replace("_", " "), d["name"]):
                text = normalize(label)[0]
                if texts.setdefault(text, d["key"]) != d["key"]:
                    problems.append(f"{text!r} names {texts[text]} and {d['key']}")
        bound: dict[str, str] = {}
        for a in aliases:
            text = normalize(a["alias"])[0]
            if a["key"] not in keys:
                problems.append(f"alias {a['alias']!r} of unknown {a['key']}")
            if bound.setdefault(text, a["key"]) != a["key"]:
                problems.append(f"alias {text!r} of {bound[text]} and {a['key']}")
        for r in refusals:
            if normalize(r["label"])[0] in bound:
                problems.append(f"{r['label']!r} is refused and an alias")
            problems += [f"{r['label']!r} has unknown candidate {k}" for k in r.get("candidates", ()) if k not in keys]
        if problems:
            raise ValueError("; ".join(sorted(problems)))
        return cls(tuple(definitions), tuple(aliases), tuple(refusals))

    def tables(self, spark: SparkSession) -> dict[str, DataFrame]:
        identity = {(normalize(x)[0], d["key"], d.get("parent_lift", UNKNOWN)) for d in self.definitions for x in (d["key"].replace("_", " "), d["name"])}
        family = {d["key"]: d.get("parent_lift", UNKNOWN) for d in self.definitions}
        by_text: dict[str, list[dict]] = {}
        for a in sorted(self.aliases, key=lambda a: (a["source_system"], a["alias"])):
            by_text.setdefault(normalize(a["alias"])[0], []).append(a)
        # the alias cited is that of the first source system by name
        alias = [(t, x[0]["key"], family[x[0]["key"]], plain_id("exercise_alias", x[0]["source_system"], x[0]["alias"], plain_id("exercise", x[0]["key"])), sorted({a["source_system"] for a in x})) for t, x in by_text.items()]
        refused = [(normalize(r["label"])[0], r.get("status", "ambiguous"), r["reason"], r.get("parent_lift", UNKNOWN), sorted(r.get("candidates", ()))) for r in self.refusals]
        defined = [(d["key"], d.get("parent_lift", UNKNOWN), *(d.get(c, UNKNOWN) for c in DESCRIPTORS)) for d in self.definitions]
        make = spark.createDataFrame
        return {
            "identity": make(sorted(identity), "text string, identity_key string, identity_family string"),
            "alias": make(alias, "text string, alias_key string, alias_family string, alias_id string, alias_systems array<string>"),
            "refused": make(refused, "text string, refused_status string, refused_reason string, refused_family string, refused_candidates array<string>"),
            "defined": make(defined, "key string, parent_lift string, " + ", ".join(f"d_{c} string" for c in DESCRIPTORS)),
        }


def _verdict(status: Column | str, method: str, key: Column | None = None, family: Column | None = None, reason: Column | str | None = None, candidates: Column | None = None, alias: Column | None = None) -> Column:
    text, none = T.StringType(), F.lit(None)
    reason = F.lit(reason) if isinstance(reason, str) else reason
    status = F.lit(status) if isinstance(status, str) else status
    parts = {"resolution_status": status, "resolution_method": F.lit(method), "exercise_key": key, "parent_lift": family, "ambiguity_reason": reason, "source_alias_id": alias}
    return F.struct(*((none if v is None else v).cast(text).alias(k) for k, v in parts.items()), (F.array() if candidates is None else candidates).cast("array<string>").alias("candidates"))


def resolve(labels: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """A verdict per row of ``labels`` (raw_label, source_system).

    Identity, curated refusal, alias (of the own source system or another), generic qualifier, structure,
    family, nothing: the first that applies.  A label that asks a question resolves to nothing more than
    an ambiguity.  A raw label that is an exercise id stands for itself.
    """
    spark = labels.sparkSession
    t = vocabulary.tables(spark)
    own = spark.createDataFrame([(plain_id("exercise", d["key"]), d["key"], d.get("parent_lift", UNKNOWN)) for d in vocabulary.definitions], "raw_label string, id_key string, id_family string")
    each = labels.select("raw_label").distinct().withColumn("p", parsed(F.coalesce("raw_label", F.lit("")))).select("raw_label", "p.*")
    described = F.lit(False)
    for c in DESCRIPTORS:
        described = described | (F.col(c) != UNKNOWN)
    agrees = F.col("family") == F.col("parent_lift")
    for c in DESCRIPTORS:
        agrees = agrees & ((F.col(c) == UNKNOWN) | (F.col(c) == F.col(f"d_{c}")))
    asked = each.where(described & (F.col("family") != UNKNOWN)).select("text", "family", *DESCRIPTORS).distinct()
    matches = asked.join(F.broadcast(t["defined"]), agrees).groupBy("text").agg(F.array_sort(F.collect_set("key")).alias("matches"))
    each = each.join(matches, "text", "left")
    for name in ("identity", "alias", "refused"):
        each = each.join(F.broadcast(t[name]), "text", "left")
    each = each.join(F.broadcast(own), "raw_label", "left")
    rows = labels.join(each, labels["raw_label"].eqNullSafe(each["raw_label"])).drop(each["raw_label"])
    tokens = F.split("text", " ")
    found = F.coalesce(F.size("matches"), F.lit(0))
    method = F.array_contains("alias_systems", F.col("source_system"))
    family = F.col("family")
    alias = {"key": F.col("alias_key"), "family": F.col("alias_family"), "alias": F.col("alias_id")}
    verdict = (
        F.when(F.col("id_key").isNotNull(), _verdict("exact_canonical", "canonical_identity", F.col("id_key"), F.col("id_family")))
        .when(F.col("identity_key").isNotNull(), _verdict("exact_canonical", "canonical_identity", F.col("identity_key"), F.col("identity_family")))
        .when(F.col("refused_reason").isNotNull(), _verdict(F.col("refused_status"), "curated_ambiguous", None, F.col("refused_family"), F.col("refused_reason"), F.col("refused_candidates")))
        .when(F.col("alias_key").isNotNull() & method, _verdict("resolved_alias", "registered_alias", **alias))
        .when(F.col("alias_key").isNotNull(), _verdict("resolved_alias", "cross_source_alias", **alias))
        .when(F.arrays_overlap(tokens, F.array(*map(F.lit, sorted(GENERIC)))), _verdict("partial_family", "generic_qualifier", None, family, "unspecified_variation"))
        .when(found == 1, _verdict("resolved_alias", "structured_interpretation", F.get("matches", F.lit(0)), family))
        .when(found > 1, _verdict("ambiguous", "structured_interpretation", None, family, "multiple_defensible_matches", F.col("matches")))
        .when(family != UNKNOWN, _verdict("partial_family", "family_keyword", None, family, F.when(F.array_contains(tokens, F.lit("machine")), "unspecified_machine").otherwise("unknown_source_taxonomy")))
        .otherwise(_verdict("unmapped", "no_match"))
    )
    doubt = F.col("question") & F.col("id_key").isNull() & F.col("v.resolution_status").isin("exact_canonical", "resolved_alias")
    asking = _verdict("ambiguous", "question_form", None, F.col("v.parent_lift"), "question_form_label", F.array("v.exercise_key"))
    out = rows.withColumn("v", verdict).withColumn("v", F.when(doubt, asking).otherwise(F.col("v")))
    return out.select("raw_label", "source_system", F.col("text").alias("normalized_label"), F.col("rules").alias("normalization_rules"), "v.*")


def definition_table(spark: SparkSession, vocabulary: Vocabulary, **provenance) -> DataFrame:
    """The vocabulary as the ``exercise_definition`` table."""
    rows = [{"exercise_id": plain_id("exercise", d["key"]), "canonical_key": d["key"], "canonical_name": d["name"], "configuration": sorted(d.get("configuration", [])), "pause": d.get("pause_rule", UNKNOWN) not in ("none", "not_specified", UNKNOWN), "quality_flags": []} | {k: v for k, v in d.items() if k not in ("key", "name", "configuration")} | provenance for d in vocabulary.definitions]
    return spark.createDataFrame([{f.name: r.get(f.name) for f in TABLES["exercise_definition"].schema} for r in rows], TABLES["exercise_definition"].schema)


def alias_table(spark: SparkSession, vocabulary: Vocabulary, **provenance) -> DataFrame:
    """The vocabulary's aliases as the ``exercise_alias`` table, one row an alias and source system."""
    rows = {}
    for a in vocabulary.aliases:
        own = plain_id("exercise", a["key"])
        alias = plain_id("exercise_alias", a["source_system"], a["alias"], own)
        rows[alias] = {"exercise_alias_id": alias, "exercise_id": own, "source_system": a["source_system"], "alias_raw": a["alias"], "alias_normalized": normalize(a["alias"])[0], "mapping_status": "resolved_alias", "quality_flags": []} | provenance
    schema = TABLES["exercise_alias"].schema
    return spark.createDataFrame([{f.name: r.get(f.name) for f in schema} for r in rows.values()], schema)


def normalization_table(resolved: DataFrame) -> DataFrame:
    """Verdicts of :func:`resolve` as the ``exercise_normalization`` table; the same label twice is one row."""
    out = resolved.dropDuplicates(["source_system", "raw_label"]).withColumns({"normalization_id": make_id("exercise_normalization", text_part(F.col("source_system")), text_part(F.col("raw_label")), text_part(F.col("normalized_label"))), "exercise_id": make_id("exercise", text_part(F.col("exercise_key"))), "candidate_exercise_ids": F.transform("candidates", lambda k: make_id("exercise", text_part(k)))})
    have = set(out.columns)
    return out.select(*((F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in TABLES["exercise_normalization"].schema))


#: When a vocabulary's artifact says it was read: always the same, so that it is the same whenever it is built.
EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)


def probe_labels(vocabulary: Vocabulary, probes: Iterable[str], source_system: str = "generic_csv") -> list[tuple[str, str]]:
    """(label, source system) of every alias, every refusal and ``probes``, each once."""
    found = {(a["alias"], a["source_system"]): None for a in vocabulary.aliases}
    found |= {(r["label"], source_system): None for r in vocabulary.refusals}
    return list(found | {(x, source_system): None for x in sorted(set(probes))})


def artifact(spark: SparkSession, vocabulary: Vocabulary, probes: Iterable[str] = ()) -> dict[str, DataFrame]:
    """The vocabulary as canonical tables: its source, definitions, aliases, and verdicts on all its own labels and ``probes``.

    Verdicts come from :func:`resolve`, successes and refusals alike, so the artifact shows what the vocabulary does.
    """
    stamp = {"source_id": f"ontology_{CURRENT['ontology']}", "ingested_at": EPOCH}
    asked = spark.createDataFrame(probe_labels(vocabulary, probes), "raw_label string, source_system string")
    verdicts = normalization_table(resolve(asked, vocabulary)).withColumns({"source_id": F.lit(stamp["source_id"]), "ingested_at": F.lit(EPOCH).cast("timestamp"), "ontology_version": F.lit(CURRENT["ontology"]), "mapping_version": F.lit(CURRENT["aliases"])})
    row = {"source_id": stamp["source_id"], "nature": "reference", "regime": "psd_reference", "publication_basis": "authored_vocabulary", "ingested_at": EPOCH}
    schema = TABLES["source"].schema
    return {
        "source": spark.createDataFrame([tuple(row.get(f.name) for f in schema)], schema),
        "exercise_definition": definition_table(spark, vocabulary, **stamp),
        "exercise_alias": alias_table(spark, vocabulary, **stamp),
        "exercise_normalization": verdicts,
    }


def coverage(resolved: DataFrame) -> DataFrame:
    return resolved.groupBy("resolution_status").agg(F.count("*").alias("n"))
