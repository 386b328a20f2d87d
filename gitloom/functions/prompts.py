"""Prompt rendering by concatenation: data may hold ``%`` and ``{...}`` safely."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the prompt texts decide the model's answers ---
FILE_SUMMARY = """# FILE_SUMMARY_PROMPT
Summarize the changes in this file in 1-2 sentences.

File: {file_path}

Diff:
{diff}

Respond with ONLY a JSON object in this exact format (no other text):
{{"file_summary": "your summary here"}}
"""
COMMIT_SYNTHESIS = """# COMMIT_SYNTHESIS_PROMPT
Based on the following per-file summaries, create a concise 2-3 sentence semantic summary of this entire commit focusing on:
1. What problem or issue was solved
2. What code patterns or logic changed
3. The business or functional impact

Commit Message: {commit_message}

File Summaries:
{file_summaries}

Respond with ONLY a JSON object in this exact format (no other text):
{{"semantic_summary": "your summary here"}}
"""
CATEGORY_DISCOVERY = """# Category Discovery Prompt

You are an expert software engineer. Given a batch of commit summaries, your task is to suggest a list of possible categories that these commits could belong to. The categories should be concise, descriptive, and mutually exclusive where possible.

## Instructions
- Read the provided commit summaries.
- Identify common themes, topics, or types of changes.
- Suggest a list of categories that best describe the set of summaries.
- Return only the list of category names.
"""
CATEGORY_DEDUPLICATION = """# Category Deduplication Prompt

You are an expert in information organization. Given a list of category names, your task is to merge duplicates and remove categories that are too similar. The goal is to produce a concise, non-overlapping set of categories.

## Instructions
- Review the provided list of category names.
- Merge categories that are duplicates or nearly identical.
- Remove categories that are too similar or redundant.
- Return only the final list of unique category names.
"""
CATEGORY_ASSIGNMENT = """# Category Assignment Prompt

You are an expert software engineer. Given a list of categories and a commit summary, assign the summary to the most appropriate category from the list. If the summary does not fit any category, assign it to "Other".

## Instructions
- Read the provided list of categories.
- For the commit summary, select the best matching category.
- If none fit, use "Other"."""
NO_THINK_SUFFIX = "\n/no_think"
# --- end of fixed values ---


def render(template: str, values: Mapping[str, Column]) -> Column:
    """Fill a ``str.format`` style template with columns (``{{`` and ``}}`` are braces)."""
    parts: list[Column] = []
    text = template.replace("{{", "\0").replace("}}", "\1")
    while text:
        start = text.find("{")
        head, text = (text, "") if start < 0 else (text[:start], text[start + 1 :])
        if head:
            parts.append(F.lit(head.replace("\0", "{").replace("\1", "}")))
        if start >= 0:
            name, text = text.split("}", 1)
            parts.append(values[name])
    return F.concat(*parts)


def file_prompt(file_path: Column, diff: Column, disable_thinking: bool = True) -> Column:
    return finish(render(FILE_SUMMARY, {"file_path": file_path, "diff": diff}), disable_thinking)


def synthesis_prompt(message: Column, summaries: Column, disable_thinking: bool = True) -> Column:
    return finish(
        render(COMMIT_SYNTHESIS, {"commit_message": message, "file_summaries": summaries}),
        disable_thinking,
    )


def discovery_prompt(numbered_summaries: Column) -> Column:
    return F.concat(F.lit(CATEGORY_DISCOVERY + "\n"), numbered_summaries)


def dedup_prompt(bulleted_categories: Column) -> Column:
    return F.concat(F.lit(CATEGORY_DEDUPLICATION + "\n"), bulleted_categories)


def assignment_prompt(bulleted_categories: Column, summary: Column) -> Column:
    return F.concat(
        F.lit(CATEGORY_ASSIGNMENT + "\nCategories:\n"),
        bulleted_categories,
        F.lit("\n\nSummary:\n"),
        summary,
    )


def finish(prompt: Column, disable_thinking: bool) -> Column:
    """Ask models that reason by default to answer directly."""
    return F.concat(prompt, F.lit(NO_THINK_SUFFIX)) if disable_thinking else prompt
