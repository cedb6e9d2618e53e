import numpy as np

from opinio.llm.threshold import Shard, scaled


def test_places_take_two_bytes_and_ruled_out_vectors_stay_out():
    rng = np.random.default_rng(2)
    matrix = scaled(rng.normal(size=(2500, 12)))
    shard, ids = Shard(matrix), np.arange(2500)
    assert shard.places.nbytes == 2 * 2 * matrix.size
    for query in range(40):
        scores = matrix @ matrix[query]
        scores[query] = -(1 << 62)
        rows, found = shard.best(matrix[query], ids, 10, query)
        assert rows.tolist() == np.lexsort((ids, -scores))[:10].tolist()
        assert found.tolist() == scores[rows].tolist()
