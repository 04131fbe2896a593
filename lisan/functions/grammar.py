"""Chunk grammars over tags, compiled to patterns over one character per node of the sentence.

A grammar is a list of stages, each a label with rules. ``{<DT>?<NN.*>+}`` makes chunks where nothing is chunked yet,
``}<VB.*>{`` takes its matches out of chunks (a chink). Between angle brackets stands a pattern for a whole tag; around
them the usual signs ``? * + | ( )``. A stage sees the chunks of the stages before it as nodes with their label.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from lisan.functions.arrays import let, running_totals

# A node's character says which tag patterns of its stage it meets: one bit each.
MOST_PATTERNS = 12
_FIRST = 0x4E00
_NODE = "array<struct<tag:string,start:int,end:int,fresh:boolean>>"


@dataclass(frozen=True)
class Stage:
    """``rules`` are (whether it makes chunks, pattern over node characters); bit k of a character is ``tags[k]``."""

    label: str
    tags: tuple[str, ...]
    rules: tuple[tuple[bool, str], ...]


def compile_stage(label: str, rules: Sequence[str]) -> Stage:
    """The stage of a label and its rules in order."""
    parts = []
    for rule in rules:
        rule = rule.strip()
        if rule[:1] + rule[-1:] not in ("{}", "}{"):
            raise ValueError(f"neither a chunk nor a chink rule: {rule}")
        body = rule[1:-1].strip()
        left = re.sub(r"<[^<>]+>", "", body)
        if re.search(r"[^\s?*+|()]", left) or not body:
            raise ValueError(f"only tags in angle brackets and ? * + | ( ) may stand in {rule}")
        parts.append((rule[0] == "{", body))
    tags = tuple(dict.fromkeys(t for _, body in parts for t in re.findall(r"<([^<>]+)>", body)))
    if len(tags) > MOST_PATTERNS:
        raise ValueError(f"more than {MOST_PATTERNS} tag patterns in the stage {label}")

    def characters(tag: str) -> str:
        bit = tags.index(tag)
        return "[" + "".join(chr(_FIRST + m) for m in range(1 << len(tags)) if m >> bit & 1) + "]"

    compiled = [
        (chunk, re.sub(r"\s+", "", re.sub(r"<([^<>]+)>", lambda m: characters(m[1]), body)).replace("(", "(?:"))
        for chunk, body in parts
    ]
    return Stage(label, tags, tuple(compiled))


def compile_grammar(grammar: Sequence[tuple[str, Sequence[str]]]) -> list[Stage]:
    """The stages of a grammar, to be run one after the other."""
    return [compile_stage(label, rules) for label, rules in grammar]


def _codes(nodes: Column, stage: Stage) -> Column:
    alphabet = "".join(chr(_FIRST + m) for m in range(1 << len(stage.tags)))

    def code(node: Column) -> Column:
        mask = F.lit(1)
        for k, tag in enumerate(stage.tags):
            # A name without signs is met by itself and, as $ has it, by itself before a line end.
            met = node["tag"].rlike(f"^(?:{tag})$")
            if tag.isalnum():
                met = F.when(node["tag"] == tag, True).otherwise(F.startswith(node["tag"], F.lit(tag)) & met)
            mask = mask + F.when(met, 1 << k).otherwise(0)
        return F.substring(F.lit(alphabet), mask, F.lit(1))

    return F.array_join(F.transform(nodes, code), "")


def _bracketed(codes: Column, stage: Stage) -> Column:
    """The characters with braces around chunks, rule after rule."""
    for chunk, pattern in stage.rules:
        if chunk:  # a brace that opens, or the end, comes before one that closes
            codes = F.regexp_replace(codes, rf"({pattern})(?=[^}}]*(?:\{{|$))", "{$1}")
        else:
            codes = F.regexp_replace(codes, rf"({pattern})(?=[^{{]*\}})", "}$1{")
        codes = F.replace(codes, F.lit("{}"), F.lit(""))
    return codes


def _next_nodes(nodes: Column, stage: Stage) -> Column:
    """The nodes with each chunk of the stage as one node."""
    def built(pieces: Column) -> Column:
        return let(
            running_totals(F.transform(pieces, F.length)),
            lambda ends: F.flatten(
                F.transform(pieces, lambda p, i: node(i, F.get(ends, i) - F.length(p), F.get(ends, i)))
            ),
        )

    def node(i: Column, first: Column, end: Column) -> Column:
        # A chunk is not fresh where it holds nothing but a node of its own label.
        known = (end - first == 1) & (F.get(nodes, first)["tag"] == stage.label)
        whole = F.struct(
            F.lit(stage.label).alias("tag"), F.get(nodes, first)["start"].alias("start"), F.get(nodes, end - 1)["end"].alias("end"),
            (~F.coalesce(known, F.lit(False))).alias("fresh"),
        )
        inside = F.slice(nodes, first + 1, end - first)
        return F.when(i % 2 == 1, F.array(whole)).otherwise(inside).cast(_NODE)

    return let(F.split(_bracketed(_codes(nodes, stage), stage), "[{}]", -1), built)


def chunks(tokens: Column, tags: Column, stages: Sequence[Stage]) -> Column:
    """array<struct<label, start_token, end_token, phrase>>: the chunks of every stage, those of the first stage first.

    Chunks may hold chunks of earlier stages. Everything happens in the sentence's row.
    """
    def old(tag: Column, start: Column, end: Column) -> Column:
        return F.struct(tag.alias("tag"), start.alias("start"), end.alias("end"), F.lit(False).alias("fresh"))

    nodes = F.transform(tags, lambda t, i: old(t, i, i + 1)).cast(_NODE)

    def run(nodes: Column, rest: Sequence[Stage]) -> Column:
        def found(after: Column) -> Column:
            fresh = F.filter(after, lambda n: n["fresh"] & (n["tag"] == rest[0].label))
            named = F.transform(
                fresh,
                lambda n: F.struct(
                    n["tag"].alias("label"), n["start"].alias("start_token"), n["end"].alias("end_token"),
                    F.array_join(F.slice(tokens, n["start"] + 1, n["end"] - n["start"]), " ").alias("phrase"),
                ),
            )
            if len(rest) == 1:
                return named
            seen = F.transform(after, lambda n: old(n["tag"], n["start"], n["end"])).cast(_NODE)
            return F.concat(named, let(seen, lambda ns: run(ns, rest[1:])))

        return let(_next_nodes(nodes, rest[0]), found)

    return let(nodes, lambda ns: run(ns, stages))
