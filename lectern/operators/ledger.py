"""Answers that were paid for: request hash to answer, in a folder that all executors reach.

Every answer is a file of its own, written beside its place and then moved there,
so that a task that is killed, repeated or run twice neither loses nor doubles one.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

RECORD = "request string, answer string, attempts int"


def request_hash(messages: list[dict], llm: str | None, max_tokens: int | None, temperature: float) -> str:
    """What is asked, of whom and how; equal requests share an answer."""
    plain = [[m["role"], m["content"]] for m in messages]
    return hashlib.sha256(json.dumps([plain, llm, max_tokens, temperature], ensure_ascii=False).encode()).hexdigest()


class Ledger:
    """The answers below a folder, by any address that ``pyarrow.fs`` opens (local, HDFS, object stores)."""

    def __init__(self, folder: str):
        # "file:/x" is how Hadoop writes a local folder.
        self.files, self.root = fs.FileSystem.from_uri(re.sub("^file:/+", "/", folder.rstrip("/")))

    def place(self, request: str) -> str:
        return f"{self.root}/{request[:2]}/{request}.json"

    def get(self, request: str) -> str | None:
        """The answer, or None if there is none yet."""
        place = self.place(request)
        if self.files.get_file_info(place).type != fs.FileType.File:
            return None
        with self.files.open_input_stream(place) as file:
            return json.loads(file.read())["answer"]

    def put(self, request: str, answer: str, attempts: int) -> None:
        """Store an answer; one that is there already may be replaced."""
        place = self.place(request)
        self.files.create_dir(place.rsplit("/", 1)[0], recursive=True)
        aside = f"{place.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
        with self.files.open_output_stream(aside) as file:
            file.write(json.dumps({"request": request, "answer": answer, "attempts": attempts}, ensure_ascii=False).encode())
        self.files.move(aside, place)


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """``request, answer, attempts``: all stored answers as a table."""
    return spark.read.schema(RECORD).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").json(folder)
