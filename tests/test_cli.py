from rillet.__main__ import main


def test_cli_list(capsys):
    assert main(["list"]) == 0
    out = capsys.readouterr().out
    assert "record_runs" in out and "stream:" in out


def test_cli_batch_job(spark, tmp_path):
    out = str(tmp_path / "out")
    assert main(["flag_runs", "--input", "/root/testdata/sf0.001", "--output", out]) == 0
    assert spark.read.parquet(f"{out}/flag_runs").count() == 170


def test_run_with_restarts():
    from rillet.streaming import run_with_restarts

    class _Q:
        def __init__(self, fail):
            self.fail, self.isActive, self.stopped = fail, True, False

        def awaitTermination(self, timeout=None):
            self.isActive = False
            if self.fail:
                raise RuntimeError("lost")

        def exception(self):
            return None

        def stop(self):
            self.stopped = True

    attempts = []

    def start():
        attempts.append(1)
        return [_Q(fail=len(attempts) < 3), _Q(fail=False)]

    assert run_with_restarts(start, restarts=5, delay_s=0) == 0 and len(attempts) == 3
    attempts.clear()
    assert run_with_restarts(lambda: [_Q(fail=True)], restarts=1, delay_s=0) == 1
