"""What scoring holds once it is done."""

import gc
import weakref

from sqlyard.operators import scoring


class Prompt(str):
    """Text that can be watched."""


def test_ask_keeps_no_prompt_after_it_returns():
    def predictor(prompts):
        if len(prompts) > 1 and "3" in prompts:
            raise ValueError("no")
        return [p.upper() for p in prompts]

    prompts = [Prompt(f"{i}") for i in range(5)]
    watched = weakref.ref(prompts[0])
    gc.disable()
    try:
        found = scoring.ask(predictor, prompts)
        assert found == [(f"{i}", None) for i in range(5)]
        del prompts
        assert watched() is None
    finally:
        gc.enable()


def test_failing_batches_are_asked_one_by_one_in_order():
    seen = []

    def predictor(prompts):
        seen.append(list(prompts))
        if len(prompts) > 1:
            return []
        if prompts == ["b"]:
            raise ValueError("bad")
        return [p + "!" for p in prompts]

    assert scoring.ask(predictor, ["a", "b", "c"]) == [("a!", None), (None, "bad"), ("c!", None)]
    assert seen == [["a", "b", "c"], ["a"], ["b"], ["c"]]
