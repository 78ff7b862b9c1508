from logloom.functions.keccak import keccak_hex
from logloom.operators import signatures as sig


def test_event_hashes():
    for h, s in sig.EVENT_SIGNATURES.items():
        assert keccak_hex(s) == h


def test_selectors():
    golden = {
        "balanceOf(address)": "70a08231", "ownerOf(uint256)": "6352211e",
        "safeTransferFrom(address,address,uint256,bytes)": "b88d4fde",
        "transferFrom(address,address,uint256)": "23b872dd", "totalSupply()": "18160ddd",
        "balanceOf(address,uint256)": "00fdd58e", "balanceOfBatch(address[],uint256[])": "4e1273f4",
        "safeBatchTransferFrom(address,address,uint256[],uint256[],bytes)": "2eb2c2d6",
    }
    for s, h in golden.items():
        assert keccak_hex(s)[2:10] == h


def test_empty_and_multiblock():
    assert keccak_hex("") == "0xc5d2460186f7233c927e7db2dcc703c0e500b653ca82273b7bfad8045d85a470"
    long = "a" * 300  # spans three 136-byte blocks
    assert len(keccak_hex(long)) == 66
