"""Digests of formatted conversations, read back from the formatted strings."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame

from gapweave.llm.chat import INSTRUCT, Template, over_conversations


class Digest:
    def __init__(self, template: Template):
        self.template = template
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0
        self.valid = True

    def add(self, row: dict) -> None:
        role, text = self.template.parse(row["formatted"])
        self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        self.n_turns += 1
        self.formatted_chars += len(row["formatted"])
        self.valid = self.valid and row["valid"]
        for segment in row["segments"]:
            if segment["loss"]:
                plain = self.template.unescape(segment["text"])
                self.loss_chars += len(plain)
                self.loss.update(plain.encode("utf-8", "surrogatepass"))

    def result(self) -> tuple:
        return (self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars, self.valid)


def digests(chats: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """``conv_id``, turn and loss digests, lengths, and whether the roles came in order."""
    columns = {"n_turns": pa.int64(), "turns_sha256": pa.string(), "loss_chars": pa.int64(), "loss_sha256": pa.string(),
               "formatted_chars": pa.int64(), "valid": pa.bool_()}
    schema = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean"
    return over_conversations(chats, lambda: Digest(template), schema, columns)
