"""Translation: eligibility, context, prompts, providers, and the state that follows from results.

State is kept as append-only events (chunk_id, status, text, at); the current
state of a chunk is the latest event. Rows don't depend on each other's
translations, so the provider stage is one mapInPandas over eligible chunks only.
"""

from __future__ import annotations

import hashlib
import json
import os
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import blank, py_rstrip, py_strip
from quire.operators.blocks import paragraphs

CONTEXT_CHARS = 500
TIMEOUT_S = 120
DONE = ("translated", "approved")
FIRST, LAST = "(start of chapter)", "(end of chapter)"
MODES = {"quick": "Translate quickly; keep the meaning.", "normal": "Translate faithfully in natural prose.", "refined": "Translate with literary care and revise the result."}
ECHO = "[echo]"


def truncate_context(text: Column, most: int = CONTEXT_CHARS) -> Column:
    return F.when(F.length(text) <= most, text).otherwise(F.concat(py_rstrip(F.substring(text, 1, most - 1)), F.lit("…")))


def first_paragraph(text: Column, most: int = CONTEXT_CHARS) -> Column:
    return truncate_context(F.get(paragraphs(text), F.lit(0)), most)


def last_paragraph(text: Column, most: int = CONTEXT_CHARS) -> Column:
    found = paragraphs(text)
    return truncate_context(F.when(F.size(found) > 0, F.element_at(found, -1)), most)


def with_context(chunks: DataFrame, keys: tuple[str, ...] = ("book_id", "chapter_id"), order: str = "sequence", text: str = "content") -> DataFrame:
    """Adds previous_summary and next_summary: paragraphs of the neighbours' source texts."""
    w = Window.partitionBy(*keys).orderBy(order)
    edges = chunks.withColumns({"_first": first_paragraph(F.col(text)), "_last": last_paragraph(F.col(text))})
    return edges.withColumns({"previous_summary": F.lag("_last").over(w), "next_summary": F.lead("_first").over(w)}).drop("_first", "_last")


def with_title(chunks: DataFrame, chapters: DataFrame) -> DataFrame:
    """Adds chapter_title, the chapter_id where the chapter is not known."""
    titles = chapters.select("book_id", "chapter_id", F.col("title").alias("_title")).dropDuplicates(["book_id", "chapter_id"])
    return chunks.join(titles, ["book_id", "chapter_id"], "left").withColumn("chapter_title", F.coalesce("_title", "chapter_id")).drop("_title")


def prompt(glossary: Column, title: Column, previous: Column, following: Column, text: Column, mode: str = "normal") -> Column:
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")

    def shown(x: Column, otherwise: str) -> Column:
        return F.when(blank(x), otherwise).otherwise(x)

    return F.concat(
        F.lit("# Glossary\n"), glossary, F.lit("\n\n# Context, for reference only\nChapter: "), title,
        F.lit("\nBefore: "), shown(previous, FIRST), F.lit("\nAfter: "), shown(following, LAST),
        F.lit("\n\n# Source\n"), text,
        F.lit(f"\n\n# Instructions\n1. {MODES[mode]}\n2. Use the glossary's terms.\n3. Keep the markdown structure, links and images.\n4. Return the translation only.\n"),
    )


def is_translated(status: Column, translation: Column) -> Column:
    return F.coalesce(status, F.lit("pending")).isin(*DONE) | ~blank(translation)


def should_translate(status: Column, translation: Column, force: bool = False, retry_failed: bool = False) -> Column:
    """The predicate to filter by before any provider is called."""
    if force:
        return F.lit(True)
    state = F.coalesce(status, F.lit("pending"))
    return blank(translation) & ~state.isin(*DONE) & (F.lit(retry_failed) | (state != "error"))


class Provider(Protocol):
    def translate(self, prompt: str) -> str: ...


class HttpProvider:
    """Posts JSON and takes the text from the answer; request and answer are functions of the service."""

    def __init__(self, url: str, headers: dict[str, str], body: Callable[[str], dict], answer: Callable[[dict], str]):
        self.url, self.headers, self.body, self.answer = url, headers, body, answer

    def translate(self, prompt: str) -> str:
        once = hashlib.sha256(f"{self.url}\n{prompt}".encode()).hexdigest()  # a call that is made again is the same request
        request = urllib.request.Request(self.url, json.dumps(self.body(prompt)).encode(), {"Content-Type": "application/json", "Idempotency-Key": once, **self.headers})
        try:
            with urllib.request.urlopen(request, timeout=TIMEOUT_S) as response:
                text = self.answer(json.loads(response.read()))
        except urllib.error.URLError as error:
            raise RuntimeError(f"the service failed: {error}") from error
        if not text or not text.strip():
            raise ValueError("the service returned no text")
        return text.strip() + "\n"


class EchoProvider:
    """Gives the source section of the prompt back."""

    def translate(self, prompt: str) -> str:
        return f"{ECHO}\n{prompt.partition('# Source\n')[2].partition('\n\n# Instructions')[0].strip()}\n"


def _need(name: str) -> str:
    value = os.environ.get(name)
    if not value:
        raise ValueError(f"{name} is not set")
    return value


def _chat() -> Provider:
    return HttpProvider(os.environ.get("OPENAI_BASE_URL", "https://api.openai.com/v1") + "/chat/completions", {"Authorization": f"Bearer {_need('OPENAI_API_KEY')}"}, lambda p: {"model": _need("OPENAI_MODEL"), "messages": [{"role": "user", "content": p}]}, lambda a: a["choices"][0]["message"]["content"])


def _messages() -> Provider:
    return HttpProvider("https://api.anthropic.com/v1/messages", {"x-api-key": _need("ANTHROPIC_API_KEY"), "anthropic-version": "2023-06-01"}, lambda p: {"model": _need("ANTHROPIC_MODEL"), "max_tokens": 4096, "messages": [{"role": "user", "content": p}]}, lambda a: "".join(x.get("text", "") for x in a["content"]))


def _local() -> Provider:
    return HttpProvider(_need("LOCAL_LLM_URL"), {}, lambda p: {"prompt": p}, lambda a: a.get("translation") or a.get("text") or a.get("response") or "")


PROVIDERS: dict[str, Callable[[], Provider]] = {"openai": _chat, "anthropic": _messages, "local": _local, "echo": EchoProvider}


def create_provider(name: str | None = None) -> Provider:
    """By argument, else the environment's LLM_PROVIDER, else the first."""
    return provider_maker(name)()


def provider_maker(name: str | None = None) -> Callable[[], Provider]:
    """What makes the provider of that name, to be called where it is needed."""
    name = name or os.environ.get("LLM_PROVIDER") or "openai"
    if name not in PROVIDERS:
        raise ValueError(f"unknown provider {name!r}; there are {', '.join(PROVIDERS)}")
    return PROVIDERS[name]


def translate(requests: DataFrame, provider: Callable[[], Provider]) -> DataFrame:
    """(chunk keys, prompt) to (keys, translation, status, error); a failing row is a row with status error.

    ``provider`` is called once per task, on the executor.
    """
    keys = [f for f in requests.schema if f.name != "prompt"]

    def task(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        service = provider()
        for part in parts:
            out = []
            for text in part["prompt"]:
                try:
                    out.append((service.translate(text), "translated", None))
                except Exception as error:  # noqa: BLE001  a chunk's failure is data
                    out.append((None, "error", str(error)))
            yield pd.concat([part[[k.name for k in keys]].reset_index(drop=True), pd.DataFrame(out, columns=["translation", "status", "error"], dtype=object)], axis=1)

    schema = ", ".join(f"`{k.name}` {k.dataType.simpleString()}" for k in keys)
    return requests.mapInPandas(task, f"{schema}, translation string, status string, error string")


def echo(text: Column) -> Column:
    """What the echo provider gives for a source text, without leaving the JVM."""
    return F.concat(F.lit(f"{ECHO}\n"), py_strip(text), F.lit("\n"))


def apply_updates(chunks: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """chunks with (translation, status, error) replaced where updates has the key."""
    own = updates.select(*keys, F.struct("translation", "status", "error").alias("_u"))
    joined = chunks.join(own, keys, "left")
    new = {c: F.when(F.col("_u").isNotNull(), F.col(f"_u.{c}")).otherwise(F.col(c) if c in chunks.columns else F.lit(None).cast("string")) for c in ("translation", "status", "error")}
    return joined.withColumns(new).drop("_u")


def current_state(events: DataFrame, keys: list[str]) -> DataFrame:
    """The latest event of each chunk."""
    rest = [c for c in events.columns if c not in keys]
    return events.groupBy(*keys).agg(F.max_by(F.struct(*rest), "at").alias("e")).select(*keys, "e.*")


def save_translation(chunks: DataFrame, keys: list[str], key: tuple, text: str, mode: str = "chat") -> DataFrame:
    """One chunk's translation put in by hand; blank text is refused."""
    if not text.strip():
        raise ValueError("an empty translation is not saved")
    own = F.lit(True)
    for name, value in zip(keys, key, strict=True):
        own &= F.col(name) == F.lit(value)
    return chunks.withColumns({"translation": F.when(own, text.strip() + "\n").otherwise(F.col("translation")), "status": F.when(own, "translated").otherwise(F.col("status")), "translation_mode": F.when(own, mode).otherwise(F.col("translation_mode") if "translation_mode" in chunks.columns else F.lit(None).cast("string"))})


def chapter_statuses(chunks: DataFrame, keys: tuple[str, ...] = ("book_id", "chapter_id")) -> DataFrame:
    """(keys, status) of chapters with chunks: translated if all are, error if any is, else chunked."""
    done = is_translated(F.col("status"), F.col("translation"))
    return chunks.groupBy(*keys).agg(F.bool_and(done).alias("all"), F.bool_or(F.coalesce(F.col("status"), F.lit("pending")) == "error").alias("any")).select(*keys, F.when(F.col("all"), "translated").when(F.col("any"), "error").otherwise("chunked").alias("status"))


def chat_status(chunks: DataFrame, keys: tuple[str, ...] = ("book_id",), retry_failed: bool = False) -> DataFrame:
    """(keys, total, translated, pending, error, next_chunk_id), chunks in the order of chapter_id and sequence."""
    done = is_translated(F.col("status"), F.col("translation"))
    open_ = should_translate(F.col("status"), F.col("translation"), retry_failed=retry_failed)
    return chunks.groupBy(*keys).agg(
        F.count("*").alias("total"), F.count_if(done).alias("translated"), F.count_if(open_).alias("pending"), F.count_if(F.col("status") == "error").alias("error"),
        F.min_by("chunk_id", F.when(open_, F.struct("chapter_id", "sequence"))).alias("next_chunk_id"),
    )


def next_chunks(chunks: DataFrame, n: int = 1, retry_failed: bool = False) -> DataFrame:
    """The first n chunks to translate: a top-n, not a sort."""
    return chunks.where(should_translate(F.col("status"), F.col("translation"), retry_failed=retry_failed)).orderBy("book_id", "chapter_id", "sequence").limit(n)


#: What stands around the prompt in a chat packet.
PACKET = ("# Translation of book {book}, chunk {chunk}", "Paste what follows into a chat, and save the answer for this chunk.", "---")


def chat_packets(chunks: DataFrame, glossary: Column, mode: str = "normal", retry_failed: bool = False) -> DataFrame:
    """(book_id, chunk_id, packet): each book's next chunk, with its context and instructions, to be pasted into a chat.

    ``chunks`` has its context (``with_context``) and chapter_title.
    """
    open_ = chunks.where(should_translate(F.col("status"), F.col("translation"), retry_failed=retry_failed))
    text = prompt(glossary, F.col("chapter_title"), F.col("previous_summary"), F.col("next_summary"), F.col("content"), mode)
    head = F.replace(F.replace(F.lit(PACKET[0]), F.lit("{book}"), F.col("book_id")), F.lit("{chunk}"), F.col("chunk_id"))
    packet = F.concat(F.concat_ws("\n\n", head, *(F.lit(x) for x in PACKET[1:])), F.lit("\n\n"), text)
    first = open_.groupBy("book_id").agg(F.min_by(F.struct("chunk_id", packet.alias("packet")), F.struct("chapter_id", "sequence")).alias("p"))
    return first.select("book_id", "p.chunk_id", "p.packet")


def packet_sql(prompt: str) -> str:
    """The same packet in SQL, around the SQL of a prompt."""
    head = "'" + PACKET[0].replace("{book}", "' || book_id || '").replace("{chunk}", "' || chunk_id || '") + "'"
    gap = " || chr(10) || chr(10) || "
    return gap.join([head, *(f"'{x}'" for x in PACKET[1:]), prompt])


def select_chunk(chunks: DataFrame, chunk_id: str | None = None, retry_failed: bool = False):
    """The named chunk, or the first to translate; ValueError if there is none."""
    row = (chunks.where(F.col("chunk_id") == chunk_id) if chunk_id else next_chunks(chunks, 1, retry_failed)).first()
    if row is None:
        raise ValueError(f"there is no chunk {chunk_id}" if chunk_id else "all chunks are translated")
    return row


def error_report(results: DataFrame) -> DataFrame:
    return results.where("status = 'error'").select(*[c for c in results.columns if c not in ("translation", "status")])
