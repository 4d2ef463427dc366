from weftline.functions import blocks, render, tokens

__all__ = ["blocks", "render", "tokens"]
