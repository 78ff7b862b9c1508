"""ABI seed documents for the fixtures (ordinal -> ABI JSON text).

Ordinals 0-2 are the public ERC-20, ERC-721 and ERC-1155 interfaces; 3 is a
settlement-style contract with indexed, tuple, tuple-array, dynamic, signed and
unnamed arguments, an overloaded function, a function without outputs and an
anonymous event; 4 is not valid JSON; 5 is missing (NULL ABI after the join).
"""

from __future__ import annotations

import json


def _arg(name, typ, indexed=None, components=None):
    d = {"name": name, "type": typ}
    if indexed is not None:
        d["indexed"] = indexed
    if components is not None:
        d["components"] = components
    return d


def _event(name, inputs, anonymous=False):
    return {"type": "event", "name": name, "anonymous": anonymous, "inputs": inputs}


def _fn(name, inputs, outputs=None, mutability="nonpayable"):
    return {"type": "function", "name": name, "inputs": inputs,
            "outputs": outputs or [], "stateMutability": mutability}


ERC20 = [
    _event("Transfer", [_arg("from", "address", True), _arg("to", "address", True),
                        _arg("value", "uint256", False)]),
    _event("Approval", [_arg("owner", "address", True), _arg("spender", "address", True),
                        _arg("value", "uint256", False)]),
    _fn("totalSupply", [], [_arg("", "uint256")], "view"),
    _fn("balanceOf", [_arg("account", "address")], [_arg("", "uint256")], "view"),
    _fn("transfer", [_arg("to", "address"), _arg("value", "uint256")], [_arg("", "bool")]),
    _fn("transferFrom", [_arg("from", "address"), _arg("to", "address"), _arg("value", "uint256")],
        [_arg("", "bool")]),
    _fn("approve", [_arg("spender", "address"), _arg("value", "uint256")], [_arg("", "bool")]),
    _fn("allowance", [_arg("owner", "address"), _arg("spender", "address")],
        [_arg("", "uint256")], "view"),
]

ERC721 = [
    _event("Transfer", [_arg("from", "address", True), _arg("to", "address", True),
                        _arg("tokenId", "uint256", True)]),
    _event("Approval", [_arg("owner", "address", True), _arg("approved", "address", True),
                        _arg("tokenId", "uint256", True)]),
    _event("ApprovalForAll", [_arg("owner", "address", True), _arg("operator", "address", True),
                              _arg("approved", "bool", False)]),
    _fn("balanceOf", [_arg("owner", "address")], [_arg("balance", "uint256")], "view"),
    _fn("ownerOf", [_arg("tokenId", "uint256")], [_arg("owner", "address")], "view"),
    _fn("safeTransferFrom", [_arg("from", "address"), _arg("to", "address"),
                             _arg("tokenId", "uint256"), _arg("data", "bytes")]),
    _fn("safeTransferFrom", [_arg("from", "address"), _arg("to", "address"),
                             _arg("tokenId", "uint256")]),
    _fn("transferFrom", [_arg("from", "address"), _arg("to", "address"), _arg("tokenId", "uint256")]),
    _fn("approve", [_arg("to", "address"), _arg("tokenId", "uint256")]),
    _fn("setApprovalForAll", [_arg("operator", "address"), _arg("_approved", "bool")]),
    _fn("isApprovedForAll", [_arg("owner", "address"), _arg("operator", "address")],
        [_arg("", "bool")], "view"),
]

ERC1155 = [
    _event("TransferSingle", [_arg("operator", "address", True), _arg("from", "address", True),
                              _arg("to", "address", True), _arg("id", "uint256", False),
                              _arg("value", "uint256", False)]),
    _event("TransferBatch", [_arg("operator", "address", True), _arg("from", "address", True),
                             _arg("to", "address", True), _arg("ids", "uint256[]", False),
                             _arg("values", "uint256[]", False)]),
    _event("ApprovalForAll", [_arg("account", "address", True), _arg("operator", "address", True),
                              _arg("approved", "bool", False)]),
    _event("URI", [_arg("value", "string", False), _arg("id", "uint256", True)]),
    _fn("balanceOf", [_arg("account", "address"), _arg("id", "uint256")], [_arg("", "uint256")], "view"),
    _fn("balanceOfBatch", [_arg("accounts", "address[]"), _arg("ids", "uint256[]")],
        [_arg("", "uint256[]")], "view"),
    _fn("setApprovalForAll", [_arg("operator", "address"), _arg("approved", "bool")]),
    _fn("isApprovedForAll", [_arg("account", "address"), _arg("operator", "address")],
        [_arg("", "bool")], "view"),
    _fn("safeTransferFrom", [_arg("from", "address"), _arg("to", "address"), _arg("id", "uint256"),
                             _arg("amount", "uint256"), _arg("data", "bytes")]),
    _fn("safeBatchTransferFrom", [_arg("from", "address"), _arg("to", "address"),
                                  _arg("ids", "uint256[]"), _arg("amounts", "uint256[]"),
                                  _arg("data", "bytes")]),
]

_ORDER = [
    _arg("sellToken", "address"), _arg("buyToken", "address"), _arg("receiver", "address"),
    _arg("sellAmount", "uint256"), _arg("buyAmount", "uint256"), _arg("validTo", "uint32"),
    _arg("appData", "bytes32"), _arg("feeAmount", "uint256"), _arg("kind", "bytes32"),
    _arg("partiallyFillable", "bool"), _arg("sellTokenBalance", "bytes32"),
    _arg("buyTokenBalance", "bytes32"),
]

SETTLEMENT = [
    _event("OrderPlacement", [
        _arg("sender", "address", True),
        _arg("order", "tuple", False, _ORDER),
        _arg("signature", "tuple", False, [_arg("scheme", "uint8"), _arg("data", "bytes")]),
        _arg("data", "bytes", False)]),
    _event("Trade", [_arg("owner", "address", True), _arg("sellToken", "address", False),
                     _arg("buyToken", "address", False), _arg("sellAmount", "uint256", False),
                     _arg("buyAmount", "uint256", False), _arg("feeAmount", "uint256", False),
                     _arg("orderUid", "bytes", False)]),
    _event("Settlement", [_arg("solver", "address", True)]),
    _event("PnL", [_arg("", "int128", False), _arg("_partition", "int64", False)]),
    _event("Swept", [_arg("amount", "uint256", False)], anonymous=True),
    _fn("settle", [_arg("tokens", "address[]"), _arg("clearingPrices", "uint256[]"),
                   _arg("trades", "tuple[]", None, [_arg("sellTokenIndex", "uint256"),
                                                   _arg("buyTokenIndex", "uint256"),
                                                   _arg("receiver", "address")])]),
    _fn("setPreSignature", [_arg("orderUid", "bytes"), _arg("signed", "bool")]),
    _fn("getBalance", [_arg("owner", "address")], [_arg("", "int128")], "view"),
    _fn("domainSeparator", [], [_arg("", "bytes32")], "view"),
    _fn("invalidateOrder", [_arg("orderUid", "bytes")]),
    _fn("invalidateOrder", [_arg("orderUid", "bytes"), _arg("deadline", "uint64")]),
]

ABI_DOCUMENTS = [
    json.dumps(ERC20),
    json.dumps(ERC721),
    json.dumps(ERC1155),
    json.dumps(SETTLEMENT),
    '[{"type": "event", "name": "Broken", "inputs": [',  # invalid JSON
]

# Allow-list of decoded table names (mixed case; one case-variant duplicate;
# one name that never occurs).
ALLOW_LIST = [
    "Token_V0_evt_Transfer",
    "TOKEN_V0_EVT_TRANSFER",
    "Token_V0_evt_Approval",
    "Token_V0_call_transfer",
    "Token_V0_call_transferFrom",
    "Token_V0_call_totalSupply",
    "Token_V0_evt_OrderPlacement",
    "Token_V0_evt_Trade",
    "Token_V0_evt_PnL",
    "Token_V0_call_settle",
    "Token_V0_call_getBalance",
    "Token_V0_call_invalidateOrder",
    "Token_V1_evt_Transfer",
    "Token_V1_evt_ApprovalForAll",
    "Token_V1_call_safeTransferFrom",
    "Token_V2_evt_TransferSingle",
    "Token_V2_evt_TransferBatch",
    "Token_V2_evt_URI",
    "Token_V2_call_balanceOfBatch",
    "Never_evt_Seen",
]

# A contract with nested arguments, one document per address (sources.fixtures.nested_abis).
_FILL = [_arg("amount", "uint256"), _arg("to", "address")]
_SIG = [_arg("scheme", "uint8"), _arg("data", "bytes")]
BATCH = _event("Batch", [_arg("who", "address", True), _arg("fills", "tuple[]", False, _FILL), _arg("grid", "uint256[][]", False),
                         _arg("notes", "string[]", False), _arg("sig", "tuple", False, _SIG)])
QUOTE = _fn("quote", [_arg("fills", "tuple[]", None, _FILL), _arg("sig", "tuple", None, _SIG)],
            [_arg("ok", "bool"), _arg("pairs", "uint256[2][]"), _arg("ok", "uint256")])
BATCH_SIGNATURE = "Batch(address,(uint256,address)[],uint256[][],string[],(uint8,bytes))"
QUOTE_SIGNATURE = "quote((uint256,address)[],(uint8,bytes))"
