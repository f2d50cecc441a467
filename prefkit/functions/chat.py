"""Message lists and their rendering as one prompt string."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# The public ChatML markers.
OPEN, CLOSE, END_OF_TEXT = "<|im_start|>", "<|im_end|>", "<|endoftext|>"
NO_THINKING = "<think>\n\n</think>\n\n"


@dataclass(frozen=True)
class ChatTemplate:
    """Markers around each message; a model's own template can be passed instead."""

    open: str = OPEN
    close: str = CLOSE
    no_thinking: str = NO_THINKING

    @property
    def answer_opener(self) -> str:
        return f"{self.open}assistant\n"


CHATML = ChatTemplate()


def message(role: str, content: Column | str) -> Column:
    content = F.lit(content) if isinstance(content, str) else content
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def prompt_messages(system: str, question: Column) -> Column:
    """System and user message. An empty system text is still a message."""
    return F.array(message("system", system), message("user", question))


def answered_messages(system: str, question: Column, answer: Column) -> Column:
    """The prompt messages and the assistant's answer."""
    return F.array(message("system", system), message("user", question), message("assistant", answer))


def render(messages: Column, template: ChatTemplate = CHATML, opener: bool = False, thinking: bool = True) -> Column:
    """Messages as text; ``opener`` leaves the assistant's turn open for generation. A message without a text makes it null."""
    body = F.array_join(
        F.transform(
            messages,
            lambda m: F.concat(
                F.lit(template.open), m["role"], F.lit("\n"), m["content"], F.lit(f"{template.close}\n")
            ),
        ),
        "",
    )
    body = F.when(~F.exists(messages, lambda m: m["content"].isNull()), body)
    tail = (template.answer_opener if opener else "") + ("" if thinking else template.no_thinking)
    return F.concat(body, F.lit(tail)) if tail else body
