"""Prompts for language-model backends: which template a call takes, and what it holds."""

from __future__ import annotations

import re

_FIELDS = '"text" (ordagrant ur texten), "label", "risk" (low, medium eller high) och "generalize" (en vagare omskrivning eller null)'
_RULES = "Svara bara med en JSON-lista. Läkemedel, doser och mätvärden är inga uppgifter om person."
TEMPLATES = {
    "targeted": "Bedöm bara de här citaten: {quotes}. Ge för vart och ett {fields}. " + _RULES,
    "full": "Hitta allt som direkt eller indirekt pekar ut en person. Ge för varje ställe {fields}. " + _RULES,
    "quasi": "Namn, nummer och adresser är redan funna ({labels}). Hitta det övriga som i samverkan pekar ut en person. Ge för varje ställe {fields}. " + _RULES,
}
SYSTEM = "Du granskar svenska journaltexter så att ingen person kan kännas igen i dem."
JUDGE = 'Texten nedan är avidentifierad. Ange det som ändå pekar ut en person som JSON-lista av "quote" och "reason". Platshållare inom hakparentes räknas inte.'
GENERALIZE = 'Skriv om varje numrerat utdrag så att det inte pekar ut någon. Svara med JSON-lista av "index" och "generalize".'


def kind(detect_direct: bool, quotes: list[str] | None) -> str:
    """Quotes come first, then the full sweep, else the sweep for indirect identifiers."""
    return "targeted" if quotes else "full" if detect_direct else "quasi"


def detection(text: str, labels: list[str], detect_direct: bool = False, quotes: list[str] | None = None, omit_generalize: bool = False) -> str:
    """The prompt of a detection call; known labels are listed sorted, so equal findings give equal prompts."""
    body = TEMPLATES[kind(detect_direct, quotes)].format(fields=_FIELDS, quotes="; ".join(f"”{q}”" for q in quotes or ()), labels=", ".join(sorted(set(labels))) or "inga")
    if omit_generalize:
        body = without_field(body, "generalize")
    return f"{body}\n\nText:\n{text}"


def without_field(prompt: str, field: str) -> str:
    """A prompt that no longer asks for a field."""
    return re.sub(rf'(?:, | och )"{field}"(?: \([^)]*\))?', "", prompt)


def generalization(text: str, spans: list[tuple[str, str]]) -> str:
    listed = "\n".join(f"{i}. ”{t}” ({label})" for i, (t, label) in enumerate(spans, 1))
    return f"{GENERALIZE}\n\nSammanhang:\n{text}\n\nUtdrag:\n{listed}"


def chat(system: str, user: str, has_system_role: bool = True) -> list[dict[str, str]]:
    """Chat messages; models without a system role get its text at the head of the user's turn."""
    if has_system_role:
        return [{"role": "system", "content": system}, {"role": "user", "content": user}]
    return [{"role": "user", "content": f"{system}\n\n{user}"}]
