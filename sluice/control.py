"""Running tasks one after another, from the command line or over HTTP."""

from __future__ import annotations

import json
import logging
import sys
import threading
from collections import OrderedDict
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs

from .config import Config, from_args, from_toml, parser
from .loader import Loader
from .logs import log


class TaskQueue:
    """Tasks in order, under rising numbers; the one at work is not in it."""

    def __init__(self) -> None:
        self._tasks: OrderedDict[int, Config] = OrderedDict()
        self._ready, self._last = threading.Condition(), 0

    def push(self, config: Config) -> int:
        with self._ready:
            self._last += 1
            self._tasks[self._last] = config
            self._ready.notify()
            return self._last

    def pop(self, timeout: float | None = None) -> tuple[int, Config] | None:
        with self._ready:
            return self._tasks.popitem(last=False) if self._ready.wait_for(lambda: bool(self._tasks), timeout) else None

    def remove(self, task: int) -> bool:
        with self._ready:
            return self._tasks.pop(task, None) is not None

    def move(self, task: int, front: bool) -> bool:
        with self._ready:
            if task not in self._tasks:
                return False
            self._tasks.move_to_end(task, last=not front)
            return True

    def ids(self) -> list[int]:
        with self._ready:
            return list(self._tasks)


class Server:
    """Tasks over HTTP: /tasks (GET, POST TOML, DELETE /tasks/N, PATCH /tasks/N/front|back), /progress/task, /progress/table?t=NAME, /loglevel (GET, PUT), /pause, /resume (GET, PUT), /metrics."""

    def __init__(self, spark, host: str = "127.0.0.1", port: int = 0):  # noqa: ANN001
        self.spark, self.queue = spark, TaskQueue()
        self.current: tuple[int, Loader] | None = None
        self.done, self.failed = 0, {}
        self.closing = threading.Event()
        outer = self

        class Handler(BaseHTTPRequestHandler):
            def log_message(self, *_):  # noqa: ANN002
                pass

            def _handle(self) -> None:
                body = self.rfile.read(int(self.headers.get("Content-Length") or 0)).decode()
                code, answer = outer.answer(self.command, self.path, body)
                raw = (answer if isinstance(answer, str) else json.dumps(answer)).encode()
                self.send_response(code)
                self.send_header("Content-Length", str(len(raw)))
                self.end_headers()
                self.wfile.write(raw)

            do_GET = do_POST = do_DELETE = do_PATCH = do_PUT = _handle  # noqa: N815

        self.http = ThreadingHTTPServer((host, port), Handler)
        self.port = self.http.server_address[1]

    def answer(self, method: str, path: str, body: str) -> tuple[int, object]:
        parts = [p for p in path.partition("?")[0].split("/") if p]
        now = self.current
        if parts[:1] == ["tasks"]:
            if method == "GET" and len(parts) == 1:
                return 200, {"current": now[0] if now else None, "queue": self.queue.ids(), "failed": self.failed}
            if method == "POST":
                try:
                    return 200, {"id": self.queue.push(from_toml(body).check())}
                except ValueError as e:
                    return 400, {"error": str(e)}
            if len(parts) < 2 or not parts[1].isdigit():
                return 400, {"error": "a task number is needed"}
            task = int(parts[1])
            if method == "DELETE":
                if now and now[0] == task:
                    now[1].stop()
                    return 200, {}
                return (200, {}) if self.queue.remove(task) else (404, {"error": "no such task"})
            if method == "PATCH" and parts[2:] in (["front"], ["back"]):
                return (200, {}) if self.queue.move(task, parts[2] == "front") else (404, {"error": "no such task"})
        if parts in (["pause"], ["resume"]):
            if method == "PUT" and now:
                (now[1].pause if parts == ["pause"] else now[1].resume)()
            return 200, {"paused": bool(now and not now[1].gate.is_set())}
        if parts == ["progress", "task"]:
            return 200, now[1].status() if now else {}
        if parts == ["progress", "table"]:
            name = parse_qs(path.partition("?")[2]).get("t", [""])[0]
            told = now[1].status()["tables"].get(name) if now else None
            return (200, told) if told else (404, {"error": "no such table"})
        if parts == ["loglevel"]:
            if method == "PUT":
                level = str(json.loads(body or "{}").get("level", "")).upper()
                if level not in logging.getLevelNamesMapping():
                    return 400, {"error": "unknown level"}
                log.setLevel(level)
            return 200, {"level": logging.getLevelName(log.getEffectiveLevel())}
        if parts == ["metrics"]:
            return 200, f"sluice_tasks_done {self.done}\nsluice_tasks_failed {len(self.failed)}\nsluice_tasks_queued {len(self.queue.ids())}\n"
        return 404, {"error": "not found"}

    def work(self) -> None:
        while not self.closing.is_set():
            if (task := self.queue.pop(0.2)) is None:
                continue
            self.current = (task[0], Loader(self.spark, task[1]))
            try:
                self.current[1].run_once()
                self.done += 1
            except Exception as e:  # noqa: BLE001
                self.failed[task[0]] = str(e)
            self.current = None

    def start(self) -> None:
        for target in (self.http.serve_forever, self.work):
            threading.Thread(target=target, daemon=True).start()

    def close(self) -> None:
        self.closing.set()
        self.http.shutdown()


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("sluice").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.server:
        host, _, port = args.server.rpartition(":")
        server = Server(spark, host or "127.0.0.1", int(port))
        server.start()
        threading.Event().wait()
    loader = Loader(spark, from_args(args))
    if args.checkpoint_remove:
        loader.store.remove(args.checkpoint_remove)
    elif args.checkpoint_error_ignore:
        loader.store.ignore_error(args.checkpoint_error_ignore)
    elif args.checkpoint_error_destroy:
        for row in loader.destroy_error(args.checkpoint_error_destroy):
            print(*row)
    elif args.checkpoint_dump:
        loader.store.dump(args.checkpoint_dump)
    else:
        for row in loader.run_once():
            print(row)
    return 0


if __name__ == "__main__":
    sys.exit(main())
