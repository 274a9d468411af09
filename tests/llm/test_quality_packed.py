import numpy as np
import pandas as pd

from citymarts.llm import quality


def test_training_rows_reach_the_driver_packed():
    texts = ["The river was calm and the boats went out early.", "BUY!! NOW!! CHEAP!! *** $$$", "one"]
    rows = pd.concat(quality._featured(iter([pd.DataFrame({"text": texts})])))
    for text, at, x in zip(texts, rows["at"], rows["x"]):
        want = quality.features(quality.Examined(text))
        assert isinstance(at, bytes) and np.frombuffer(at, "<i4").tolist() == [*want]
        assert isinstance(x, bytes) and np.frombuffer(x, "<f8").tolist() == [*want.values()]
