"""A stand-in for a DB-API driver with COPY: what it is told goes into files, statements into a log."""

import os
import uuid

FOLDER = "FILEDB_FOLDER"
FAIL_ONCE = "FILEDB_FAIL_ONCE"
FAIL_STATEMENT = "FILEDB_FAIL_STATEMENT"


class Cursor:
    def __init__(self, folder):
        self.folder = folder

    def _note(self, name, text):
        with open(os.path.join(self.folder, f"{name}-{uuid.uuid4().hex}"), "w", encoding="utf-8", newline="") as out:
            out.write(text)

    def execute(self, statement):
        with open(os.path.join(self.folder, "statements"), "a", encoding="utf-8") as out:
            out.write(statement + "\n")
        refused, marker = os.environ.get(FAIL_STATEMENT), os.path.join(self.folder, "refused")
        if refused and statement.startswith(refused) and not os.path.exists(marker):
            open(marker, "w").close()
            raise OSError("connection lost at a statement")

    def copy_expert(self, statement, file):
        data = b""
        while piece := file.read(8192):
            data += piece
        self._note("copied", data.decode())
        self._note("copy", statement)
        marker = os.path.join(self.folder, "failed")
        if os.environ.get(FAIL_ONCE) and data and not os.path.exists(marker):
            open(marker, "w").close()
            raise OSError("connection lost after the rows were sent")


class Connection:
    def cursor(self):
        return Cursor(os.environ[FOLDER])

    def commit(self):
        pass

    def close(self):
        pass


def connect():
    return Connection()
