"""Classes by keyword and rule; an external model's answer, where a column has one, comes first."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.text import first_match

#: Class and words, in the order in which they are tried.
PLAIN = [(n, w.split("/")) for n, w in (("exclusion", "면책/부지급/지급하지 않/보상하지 않"), ("duty", "알릴 의무/고지의무/통지 의무"), ("claim", "보험금 청구/청구 절차/청구서류"), ("termination", "해지/효력상실/소멸"), ("special_clause", "특약/특별"), ("definition", "정의/용어"), ("coverage", "보장/지급/보험금"))]
FIRST = [(n, w.split("/")) for n, w in (("duty", "알릴 의무/고지의무/통지"), ("claim", "청구/지급 절차"), ("termination", "해지/소멸/효력"), ("exclusion", "면책/지급하지 않"), ("schedule", "별표/부표/장해분류"))]


def plain_class(text: Column, rules=None) -> Column:
    return first_match(text, PLAIN if rules is None else rules, "general")


def chunk_class(text: Column, label: Column, first=None, rules=None) -> Column:
    """Class of a chunk by its label and text: the overriding words first, then the plain ones."""
    both = F.concat(F.coalesce(label, F.lit("")), F.lit(" "), text)
    return first_match(both, [*(FIRST if first is None else first), *(PLAIN if rules is None else rules)], "general")


def rule_class(text: Column, title: Column) -> Column:
    """special_clause where a clause only applies the general terms; else null."""
    applies = F.contains(F.coalesce(title, F.lit("")), F.lit("준용")) | F.rlike(F.substring(text, 1, 300), F.lit(r"(?U)정하지\s*않은\s*사항.{0,20}약관.{0,10}따[릅른]"))
    return F.when(applies, "special_clause")


def ambiguous(text: Column, found: Column) -> Column:
    """Whether words of both exclusion and coverage are there, and the class is one of the two."""
    any_of = lambda name: F.exists(F.array(*[F.lit(w) for n, ws in PLAIN if n == name for w in ws]), lambda w: F.contains(text, w))
    return found.isin("exclusion", "coverage") & any_of("exclusion") & any_of("coverage")


def resolved(model: Column, text: Column, title: Column, label: Column) -> Column:
    """Rule, else the model's answer, else keywords."""
    return F.coalesce(rule_class(text, title), model, chunk_class(text, label))


def document_type(name: Column, rules=None) -> Column:
    """Type by file name; product_summary if nothing tells."""
    rules = rules or [("product_summary", "요약서|상품안내|상품설명서"), ("policy_terms", "약관"), ("schedule", "산출기준표|보험료표|지급률표|장해분류표")]
    out = None
    for name_, p in rules:
        out = F.when(F.rlike(name, F.lit(p)), name_) if out is None else out.when(F.rlike(name, F.lit(p)), name_)
    return out.otherwise("product_summary")


def catalogue_type(category: Column, by_name: Column, name: Column) -> Column:
    """Terms by the catalogue that are a summary only for want of a better guess are terms."""
    return F.when((category == "terms") & (by_name == "product_summary") & ~F.rlike(name, F.lit("요약|안내|설명서")), "policy_terms").otherwise(by_name)
