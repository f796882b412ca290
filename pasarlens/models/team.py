"""Processes of one task that share its work.

The task forks them before it has read its rows, deals the rows out and calls their methods; each call goes
to all of them at once.  They end with the task, whatever ends it: a closed pipe is the sign.
"""

from __future__ import annotations

import os
import traceback
from collections.abc import Callable, Iterable, Iterator
from multiprocessing import Pipe
from multiprocessing.connection import Connection

import pyarrow as pa


def serve(pipe: Connection, make: Callable[[Iterator[pa.RecordBatch]], object]) -> None:
    """The life of a member: it takes batches until None, then calls until None."""
    try:
        member = make(iter(pipe.recv, None))
        pipe.send((True, None))
        for name, given in iter(pipe.recv, None):
            pipe.send((True, getattr(member, name)(*given)))
    except EOFError:
        pass
    except BaseException:
        try:
            pipe.send((False, traceback.format_exc()))
        except OSError:
            pass
    finally:
        os._exit(0)


class Team:
    """``make`` builds member ``number`` from the batches it is given, in a process of its own."""

    def __init__(self, size: int, make: Callable[[int, Iterator[pa.RecordBatch]], object]):
        self.pipes: list[Connection] = []
        self.processes: list[int] = []
        for number in range(size):
            here, there = Pipe()
            process = os.fork()
            if not process:
                for mine in (here, *self.pipes):
                    mine.close()
                serve(there, lambda batches: make(number, batches))
            there.close()
            self.pipes.append(here)
            self.processes.append(process)

    def given(self, batches: Iterable[pa.RecordBatch], dealt: bool) -> None:
        """Hand out all batches: a part of the rows to each member, or all rows to all."""
        try:
            size = len(self.pipes)
            for batch in batches:
                edges = [batch.num_rows * i // size for i in range(size + 1)]
                for pipe, a, z in zip(self.pipes, edges, edges[1:]):
                    some = batch.slice(a, z - a) if dealt else batch
                    if some.num_rows:
                        pipe.send(some)
            for pipe in self.pipes:
                pipe.send(None)
        except (BrokenPipeError, ConnectionResetError):
            pass  # the answer tells why
        self.answers()

    def answers(self) -> list:
        found = []
        for pipe in self.pipes:
            try:
                fine, answer = pipe.recv()
            except (EOFError, ConnectionResetError):
                raise RuntimeError("a process of the task has ended") from None
            if not fine:
                raise RuntimeError(answer)
            found.append(answer)
        return found

    def each(self, name: str, *given) -> list:
        """What every member answers, in their order."""
        for pipe in self.pipes:
            pipe.send((name, given))
        return self.answers()

    def close(self) -> None:
        for pipe in self.pipes:
            pipe.close()
        for process in self.processes:
            os.waitpid(process, 0)
        self.pipes, self.processes = [], []
