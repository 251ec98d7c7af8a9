import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_executors_get_the_package(tmp_path):
    """From another folder, workers only know what is shipped to them."""
    code = f"""
        import sys
        sys.path.insert(0, {REPO!r})
        from pyspark.sql import SparkSession
        import corpusmill
        from corpusmill.operators import quality
        spark = SparkSession.builder.master("local-cluster[1,1,1024]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "1").getOrCreate()
        assert corpusmill.ship(spark) == corpusmill.ship(spark)

        def use(parts):
            from corpusmill import domain
            for p in parts:
                yield p.assign(n=len(domain.INTENTS))

        print("rows", spark.range(3).mapInPandas(use, "id long, n long").collect()[0]["n"])
        spark.stop()
    """
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert "rows 13" in out.stdout, out.stderr[-2000:]
