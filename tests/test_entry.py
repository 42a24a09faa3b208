import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_optional_parts(tmp_path):
    """The entry point imports and lists its own queries where the training-data operators are taken out."""
    for name in os.listdir(ROOT):
        if name not in (".git", "corpus_pipeline.py", "korrel"):
            os.symlink(f"{ROOT}/{name}", tmp_path / name)
    (tmp_path / "korrel").mkdir()
    for name in os.listdir(f"{ROOT}/korrel"):
        if name != "llm":
            os.symlink(f"{ROOT}/korrel/{name}", tmp_path / "korrel" / name)
    (tmp_path / "__spark_entry__.py").unlink()
    (tmp_path / "__spark_entry__.py").write_text(open(f"{ROOT}/__spark_entry__.py").read())
    code = "import __spark_entry__ as e; q = e.queries(); assert 'q_block_all' in q and 'pipeline' not in q and not [x for x in q if x.startswith('op')]; assert set(e.oracle_sql()) <= set(q)"
    done = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["source1_entity_id", "candidate_entity_ids"] and df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_without_a_library_of_the_optional_parts():
    for name in ("ahocorasick", "sentencepiece", "xxhash"):
        code = f"import sys; sys.modules['{name}'] = None; import __spark_entry__ as e; q = e.queries(); assert 'q_block_all' in q and 'op6_pieces' not in q; assert set(e.oracle_sql()) <= set(q)"
        done = subprocess.run([sys.executable, "-B", "-c", code], cwd=ROOT, env={**os.environ, "PYTHONPATH": ROOT}, capture_output=True, text=True)
        assert done.returncode == 0, done.stderr
