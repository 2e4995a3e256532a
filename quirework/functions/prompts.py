"""System prompts: what the generator and the verifier are asked for, and the shape of their answers.

The wording is this library's own; what has to agree with the parsers and the validators, such as
field names, classes and required headings, is put in from the rule tables.
"""

from __future__ import annotations

import os

from quirework.functions import rules


def _listed(items) -> str:
    return "\n".join(f"- {x}" for x in items)


def _headings() -> str:
    return "\n\n".join(f"For `{kind}` use these headings, in this order:\n{_listed(f'## {h}' for h in heads)}" for kind, heads in rules.REQUIRED_HEADINGS.items())


GENERATOR = f"""You turn one section of a technical manual into one entry of a knowledge base for network engineers.

# Answer

Answer with a single JSON object and nothing around it. Its fields:
- "decision": "generate" or "skip"
- "skip_reason": why the section is skipped, else null
- "kb_type": one of {", ".join(f'"{k}"' for k in rules.KB_TYPES)}; needed when you generate
- "kb_filename": a short name in lower case with dashes, without extension
- "kb_content": the entry in markdown, beginning with YAML front matter

# Classes

- config: the section tells how to set something up, with commands or steps that change a device.
- theory: it explains what something is or how it works, without steps.
- troubleshooting: it tells how to check, diagnose or repair, with what to look for.
Take the class that the text itself supports. The likely type in the request is a guess and may be wrong.

# When to skip

Skip only what is of no use to any of the three classes:
{_listed(rules.SKIP_RULES)}

# Shape of an entry

The front matter holds id, platform, features, keywords, and source with chapter, section and pages.

{_headings()}

# Faithfulness

{_listed(rules.FIDELITY_RULES)}
"""

VERIFIER = f"""You check a knowledge base entry against the text it was made from. Every statement of fact in the entry has to be supported by that text.

# Answer

Answer with a single JSON object and nothing around it. Its fields:
- "decision": "PASS" if there is no problem, else "FLAG"
- "problems": a list, empty on PASS. Each problem has "category", "claim" (the words of the entry), "issue" (what is wrong) and "severity".

Categories: {", ".join(rules.PROBLEM_CATEGORIES)}.
Severities: {", ".join(rules.SEVERITIES)}.

# Check above all

{_listed(rules.MUST_CHECK)}

Other words for the same meaning, another order, and things left out are no problems; nor is front matter that the text doesn't show.
"""


def system_prompt(role: str, path: str | None = None) -> str:
    """The prompt of a role, "generate" or "verify"; the text of a file where one is given.

    Without ``path``, QUIREWORK_GENERATOR_PROMPT or QUIREWORK_VERIFIER_PROMPT may name one.
    """
    path = path or os.environ.get({"generate": "QUIREWORK_GENERATOR_PROMPT", "verify": "QUIREWORK_VERIFIER_PROMPT"}[role])
    if path:
        with open(path, encoding="utf-8") as f:
            return f.read()
    return {"generate": GENERATOR, "verify": VERIFIER}[role]
