"""A write that failed while other tasks still wrote."""
import os
import threading
import time

from rungline.sources import sinks


def test_abort_outlasts_late_tasks(tmp_path):
    """Deleting failed, or a late task made the folder again: its files were left beside the target."""
    writer = sinks._DocumentWriter(str(tmp_path / "felog"))
    begun = threading.Event()

    def late():
        end = time.time() + 0.5
        while time.time() < end:
            try:
                os.makedirs(writer.staged, exist_ok=True)
                open(os.path.join(writer.staged, f".{time.time_ns()}"), "w").close()
            except OSError:
                pass
            begun.set()

    task = threading.Thread(target=late)
    task.start()
    begun.wait()
    writer.abort([])
    task.join()
    assert os.listdir(tmp_path) == []
