"""Content hashes and deterministic identifiers."""

from __future__ import annotations

from lectern.functions.text import col
from pyspark.sql import Column
from pyspark.sql import functions as F


def content_hash(kind: str, *fields: Column | str) -> Column:
    """SHA-256 of kind and fields, joined by colons; null fields make a null hash."""
    return F.sha2(F.concat(F.lit(kind), *(F.concat(F.lit(":"), col(f).cast("string")) for f in fields)), 256)


def verse_hash(chapter: Column, verse: Column, text: Column) -> Column:
    return content_hash("ayah", chapter, verse, text)


def verse_translation_hash(chapter: Column, verse: Column, edition: Column, text: Column) -> Column:
    return content_hash("ayah-translation", chapter, verse, edition, text)


def verse_commentary_hash(chapter: Column, verse: Column, edition: Column, text: Column) -> Column:
    return content_hash("ayah-tafsir", chapter, verse, edition, text)


def narration_hash(collection: Column, number: Column, text: Column) -> Column:
    return content_hash("hadith", collection, number, text)


def narration_translation_hash(collection: Column, number: Column, language: Column, text: Column) -> Column:
    return content_hash("hadith-translation", collection, number, language, text)


def page_hash(book: Column, page: Column, text: Column) -> Column:
    return content_hash("page", book, page, text)


def page_translation_hash(book: Column, page: Column, language: Column, paragraphs: Column) -> Column:
    """paragraphs: array of (index, translation); hashed as compact JSON with the fields in this order."""
    listed = F.transform(paragraphs, lambda p: F.struct(p["index"].alias("index"), p["translation"].alias("translation")))
    return content_hash("page-translation", book, page, language, F.to_json(listed, {"ignoreNullFields": "false"}))


def dictionary_entry_hash(source: Column, headword: Column, definition: Column) -> Column:
    return content_hash("dict-entry", source, headword, definition)


def point_id(*parts: Column | str, sep: str = "_") -> Column:
    """A deterministic identifier of a vector's key."""
    return F.md5(F.concat_ws(sep, *(col(p).cast("string") for p in parts)))
