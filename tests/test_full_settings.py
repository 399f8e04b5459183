from claimweave.config import TrainParams
from claimweave.workload import queries


def test_fitted_queries_use_the_full_settings(monkeypatch):
    seen = []
    monkeypatch.setattr(queries, "_dialog_vectors", lambda spark, sf: None)
    monkeypatch.setattr(queries, "stage", lambda frame, name: frame)
    monkeypatch.setattr(queries.training, "pair_feature_rows", lambda vectors: vectors)
    monkeypatch.setattr(queries, "_stance_features", lambda spark, sf: None)
    monkeypatch.setattr(queries, "_checked_comparison", lambda result, labels: None)
    monkeypatch.setattr(queries.training, "train_and_compare", lambda *a, **k: seen.append(a[2]))
    monkeypatch.setattr(queries.training, "ablate_features", lambda *a: seen.append(a[2]))
    queries.train_compare(None, "")
    queries.train_compare_stance(None, "")
    queries.feature_ablation(None, "")
    assert seen == [TrainParams()] * 3
