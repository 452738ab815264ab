from corpuslake.functions.item_ids import item_id, item_id_names, register_item_id
from corpuslake.functions.modifiers import modifier_chain, register_modifier
from corpuslake.functions.text import empty_to_null, initial_cap, long_to_null, ngram_hash
from corpuslake.functions.udfeats import feat_sets, feats_key

__all__ = [
    "empty_to_null",
    "feat_sets",
    "feats_key",
    "initial_cap",
    "item_id",
    "item_id_names",
    "long_to_null",
    "modifier_chain",
    "ngram_hash",
    "register_item_id",
    "register_modifier",
]
