"""A stand-in for a DB-API driver with transactions: each is a journal file, there as a whole or not at all.

``TXDB_FAIL`` lists failures, each of which happens once: ``before <text>`` loses a transaction that holds a statement beginning with
the text, ``after <text>`` keeps it but reports a lost connection.
"""

import json
import os
import re
import time
import uuid

FOLDER, FAIL = "TXDB_FOLDER", "TXDB_FAIL"


def journal(folder):
    """The transactions in their order, each a list of (statement, text copied)."""
    found = []
    for name in sorted(n for n in os.listdir(folder) if n.endswith(".json")):
        with open(os.path.join(folder, name), encoding="utf-8") as file:
            found.append([tuple(step) for step in json.load(file)])
    return found


class Cursor:
    def __init__(self, connection):
        self.connection, self.asked = connection, None

    def execute(self, statement):
        self.asked = statement
        if not statement.startswith("SELECT"):
            self.connection.steps.append((statement, None))

    def fetchone(self):
        """Answers the one question that is asked: the last epoch that a table of epochs has of a stream."""
        table, stream = re.fullmatch(r"SELECT max\(epoch\) FROM (\w+) WHERE stream = '([^']+)'", self.asked).groups()
        noted = re.compile(rf"INSERT INTO {table}\(stream, epoch\) VALUES \('{stream}', (\d+)\)")
        epochs = [int(m[1]) for steps in journal(os.environ[FOLDER]) for s, _ in steps if (m := noted.fullmatch(s))]
        return (max(epochs, default=None),)

    def copy_expert(self, statement, file):
        data = b""
        while piece := file.read(8192):
            data += piece
        self.connection.steps.append((statement, data.decode()))


class Connection:
    def __init__(self):
        self.steps = []

    def cursor(self):
        return Cursor(self)

    def _failure(self):
        for number, entry in enumerate(filter(None, os.environ.get(FAIL, "").split(","))):
            when, _, start = entry.partition(" ")
            marker = os.path.join(os.environ[FOLDER], f"failed-{number}")
            if any(s.startswith(start) and text != "" for s, text in self.steps) and not os.path.exists(marker):
                open(marker, "w").close()
                return when
        return None

    def commit(self):
        failure = self._failure()
        if failure != "before":
            path = os.path.join(os.environ[FOLDER], f"{time.time_ns():020d}-{uuid.uuid4().hex}")
            with open(f"{path}.part", "w", encoding="utf-8") as out:
                json.dump(self.steps, out)
            os.replace(f"{path}.part", f"{path}.json")
        self.steps = []
        if failure:
            raise OSError("connection lost at a commit")

    def close(self):
        pass


def connect():
    return Connection()
