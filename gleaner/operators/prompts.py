"""Prompt texts over rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import truncate_marker

# Wording that the prompts must carry.
SYSTEM_BASE = "You are a helpful assistant that answers questions based on the provided context."
SYSTEM_STRICT = (
    "You are a helpful assistant that answers using only the provided context. "
    "If the answer is not contained in the context, say you don't know."
)
SYSTEM_FLAT = (
    "You are a helpful assistant. Give brief and accurate answers. Use the following context to answer "
    "the user's question. If the information is not in the context, say that you don't have enough "
    "information to answer. Do not make anything up if you haven't been provided with relevant context."
)
SYSTEM_SUMMARY = (
    "You are an assistant that analyzes the contents of a website and provides a short summary, ignoring "
    "text that might be navigation related. If the website contains news or announcements, summarize these "
    "too. Respond in markdown."
)
SYSTEM_BROCHURE = (
    "You are an assistant that analyzes the contents of several relevant pages from a company website and "
    "creates a short brochure about the company for prospective customers investors and recruits. Respond in "
    "markdown.Include details of company culture, customers and careers/jobs if you have the information."
)
SYSTEM_LINKS = (
    "You are provided with a list of links found on a webpage. You are able to decide which of the links would "
    "be most relevant to include in a brochure about the company, such as links to an About page, or a Company "
    "page, or Careers/Jobs pages.\nYou should ignore links to Terms of Service, Privacy Policy, email links, "
    "etc.\n"
)
CONTEXT_CAP = 12_000
BROCHURE_CAP = 20_000


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def prompt_base(context: Column, question: Column, system: str = SYSTEM_BASE) -> Column:
    return _text(system, "\n\nContext:\n", context, "\n\nQuestion: ", question, "\n\nAnswer:")


def prompt_sonnet(context: Column, question: Column) -> Column:
    lead = (
        "Based on the following context, please answer the question. If the answer cannot be found in the "
        "context, please state that clearly."
    )
    return _text(lead, "\n\nContext:\n", context, "\n\nQuestion: ", question, "\n\nAnswer:")


def prompt_gpt5(
    context: Column, question: Column, cap: int | None = CONTEXT_CAP, system: str = SYSTEM_STRICT
) -> Column:
    return _text(
        system, "\n\n=== Retrieved Context ===\n", truncate_marker(context, cap),
        "\n\n=== Task ===\nQuestion: ", question,
        "\nAnswer using ONLY the retrieved context above.\n",
    )


def prompt_gemini(context: Column, question: Column) -> Column:
    return _text(
        "Based on the following context, answer the user's query:\n\nContext:\n", context,
        "\n\nQuery: ", question, "\n\nAnswer:",
    )


def prompt_flat(context: Column, question: Column, indent: int = 4) -> Column:
    pad = " " * indent
    return _text(f"\n{pad}Context:\n{pad}", context, f"\n\n{pad}User's question: ", question, f"\n{pad}")


def prompt_summary(title: Column, contents: Column) -> Column:
    return _text(
        "You are looking at a website titled ", title,
        "\nThe contents of this website is as follows; please provide a short summary of this website in "
        "markdown. If it includes news or announcements, then summarize these too.\n Respond in Markdown\n\n",
        contents,
    )


def prompt_links(url: Column, links: Column) -> Column:
    return _text(
        "Here is the list of links on the website of ", url,
        ".\nPlease decide which of these are relevant web links for a brochure about the company, respond with "
        "the full https URL in JSON format. Do not include Terms of Service, Privacy, email links.\n"
        "Links (some might be relative links):\n",
        F.array_join(links, "\n"),
    )


def brochure_lead(company: Column) -> Column:
    return _text(
        "You are looking at a company called: ", company,
        "\nHere are the contents of its landing page and other relevant pages; use this information to build a "
        "short brochure of the company in markdown.\n",
    )


def message_pair(system: Column | str, user: Column) -> Column:
    """``[{role: system, content}, {role: user, content}]``."""

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    system = F.lit(system) if isinstance(system, str) else system
    return F.array(message("system", system), message("user", user))
